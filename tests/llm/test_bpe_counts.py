import hashlib
import random
import sys

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from conftest import SF_SMALL
from rivulet.llm import bpe
from rivulet.llm import token_counts as T

PATH, PATTERN = bpe.tokenizer()
RANKS = bpe.load_ranks(PATH)
TIKTOKEN = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})
BITS = ["a", "b", "Z", " ", "  ", "\n", "\t", "é", "ß", "中", "1", "²", "٣", "'s", "'ll", "😀", "_", "\u00a0", "\u2003",
        "\x1c", "x" * 30, "ab" * 90, "-" * 70, "#", "Ⅷ", "\u0301", " " * 100, "\u200b", "<|endoftext|>", "the ", "ing"]


def mix(rng, n):
    return "".join(rng.choice(BITS) for _ in range(n))


def test_ids_equal_tiktoken():
    rng, codec = random.Random(3), bpe.Codec(RANKS, PATTERN)
    for text in ["", *(mix(rng, rng.randint(0, 25)) for _ in range(3000)), "q" * 5000, mix(rng, 4000)]:
        ids = codec.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == TIKTOKEN.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


def test_a_text_is_split_by_classes_no_wider_than_itself():
    whole, split = bpe.compiled(PATTERN, sys.maxunicode + 1), bpe.splitter(PATTERN)
    last = (1 << 7, 1 << 16, sys.maxunicode + 1)
    rng = random.Random(7)
    for limit in last:
        bits = [c for c in (*BITS, "\uffff", "\uff21", "\U00010000", "\U0001d400", "\U0010ffff") if max(map(ord, c)) < limit]
        for _ in range(300):
            text = "".join(rng.choices(bits, k=rng.randint(0, 40)))
            assert split.findall(text) == whole.findall(text)
            at = rng.randint(0, len(text))
            assert [m.span() for m in split.finditer(text, at)] == [m.span() for m in whole.finditer(text, at)]
    assert [split._of(t) for t in ("a", "é", "a😀")] == [bpe.compiled(PATTERN, n) for n in last]


def test_word_table_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 3)
    codec = bpe.Codec(RANKS, PATTERN)
    assert codec.decode(codec.encode("one two three four five one two")) == b"one two three four five one two"
    assert len(codec.words) <= 3


@pytest.mark.parametrize("file", ["byte_bpe_50k.tiktoken"])
def test_other_rank_file(file):
    ranks = bpe.load_ranks(public_tokenizers.path(file))
    other = tiktoken.Encoding("o", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    codec = bpe.Codec(ranks, PATTERN)
    assert np.frombuffer(codec.encode("Hello wörld 12"), "<u4").tolist() == other.encode_ordinary("Hello wörld 12")


def test_query_matches_tiktoken(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    for r in bpe.op6_bpe(spark, SF_SMALL).collect():
        ids = TIKTOKEN.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(texts[r.doc_id].encode()).hexdigest())


def test_nulls_repeats_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, None, 9), (2, "", 9), (2, "", 9), (None, "x", 9), (3, "y" * 300_000, 9)],
                               "doc_id long, text string, n_words long")
    got = bpe.round_trip(df, PATH, PATTERN).collect()
    none = hashlib.sha256(b"").hexdigest()
    assert sorted((r.doc_id, r.n_tokens) for r in got if r.doc_id in (1, 2)) == [(1, 0), (2, 0), (2, 0)]
    assert all(r.ids_sha256 == r.decoded_sha256 == none for r in got if r.doc_id in (1, 2))
    assert bpe.round_trip(df.limit(0), PATH, PATTERN).collect() == []
    assert bpe.bpe_stage(spark, df, "").count() == 5


def test_native_fold_gives_the_same_ids(spark):
    words = ["the", " hello", "ingthe", "é", "  ", "zzqx", "a"]
    got = bpe.fold_words(spark.createDataFrame([(w,) for w in words], "word string"), PATH).collect()
    assert {r.word: r.ids for r in got} == {w: bpe.fold(w.encode(), RANKS) for w in words}


def test_edited_counts_equal_a_fresh_count():
    rng, split, counter = random.Random(5), bpe.splitter(PATTERN), T.Counter(RANKS)
    for _ in range(600):
        text = mix(rng, rng.randint(0, 300))
        doc = T.Counted.build(text, split, counter)
        for _ in range(3):
            start, deleted, new = rng.randint(-2, len(text) + 3), rng.randint(-1, 60), mix(rng, rng.choice([0, 2, 150]))
            doc.edit(start, deleted, new, split, counter)
            start = min(max(start, 0), len(text))
            text = text[:start] + new + text[min(len(text), start + max(deleted, 0)):]
            fresh = T.Counted.build(text, split, counter)
            assert doc.text == text and doc.ends.tolist() == fresh.ends.tolist()
            assert doc.counts.tolist() == fresh.counts.tolist()
            assert doc.total == fresh.total == len(TIKTOKEN.encode_ordinary(text))


def test_counts_query_matches_brute_force(spark):
    got = {r.doc_id: r for r in T.op8_token_counts(spark, SF_SMALL).collect()}
    for d in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect():
        t, n = d.text, len(d.text)
        e = t[:n // 3] + t[:n // 100] + t[n // 3 + n // 50:]
        e = e[:n // 10] + " edited" + e[n // 10:]
        r = got[d.doc_id]
        assert (r.n_tokens_before, r.n_tokens, r.n_chars) == (
            len(TIKTOKEN.encode_ordinary(t)), len(TIKTOKEN.encode_ordinary(e)), len(e))
        assert n < 2000 or r.encoded_chars < n / 4


def test_counts_of_nulls_and_null_edits(spark):
    df = spark.createDataFrame([(1, None, None), (2, "", [(0, 0, "new words")]), (2, "", [(0, 0, "new words")]),
                                (3, "some text here", [None, (None, None, None), (5, 4, None)]), (4, "x", [])],
                               f"doc_id long, text string, edits {T.EDITS}")
    state = T.build_counts(df, PATH, PATTERN)
    got = T.apply_edits(state, PATH, PATTERN).select("doc_id", "text", "n_tokens_before", "n_tokens").collect()
    assert sorted(map(tuple, got)) == [(1, "", 0, 0), (2, "new words", 0, 2), (2, "new words", 0, 2),
                                       (3, "some  here", 3, len(TIKTOKEN.encode_ordinary("some  here"))),
                                       (4, "x", 1, 1)]
    assert T.apply_edits(state.limit(0), PATH, PATTERN).collect() == []
    again = T.apply_edits(T.apply_edits(state, PATH, PATTERN).drop("n_tokens_before", "n_tokens", "encoded_chars")
                          .withColumn("edits", F.expr(f"cast(array() as {T.EDITS})")), PATH, PATTERN)
    assert [r.n_tokens for r in again.orderBy("doc_id").collect()] == [0, 2, 2, 3, 1]
