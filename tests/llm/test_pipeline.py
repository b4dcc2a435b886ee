import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from rivulet.llm import bpe, mixing, quality, token_counts
from test_similarity_join import components, shingles

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_and_entry():
    import __spark_entry__ as E
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "mixing", "tokens"]
    assert E.queries()["pipeline"] is corpus_pipeline.run
    names = [q for q in E.queries() if q.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))


def test_run_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = quality.learn(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    sizer = quality.Sizer(model)
    rows = [r for r in docs.orderBy("doc_id").collect()
            if quality.sigmoid(np.dot(sizer.features(r.text), model.weights)) >= 0.3]
    sets, pairs = {r.doc_id: shingles(r.text) for r in rows}, []
    for i, x in sets.items():
        for j, y in sets.items():
            if j < i and x and y and 100 * len(x & y) >= 80 * len(x | y):
                pairs.append((i, j))
    top = components(pairs, list(sets))
    rows = [r for r in rows if top[r.doc_id] == r.doc_id]
    left = spark.createDataFrame(rows, docs.schema)
    kept = {r.doc_id for r in mixing.mix(left, "doc_id", mixing.n_words(F.col("text")),
                                         mixing.document_dimensions()).where("kept").collect()}
    codec = bpe.Codec(bpe.load_ranks(bpe.tokenizer()[0]), bpe.tokenizer()[1])
    want = {r.doc_id: len(codec.encode(r.text)) // 4 for r in rows if r.doc_id in kept}
    assert {r.doc_id: r.n_tokens for r in corpus_pipeline.run(spark, SF_SMALL).collect()} == want and want


@pytest.mark.parametrize("k", range(4))
def test_each_stage_takes_empty_and_awkward_rows(spark, k):
    name, stage = corpus_pipeline.STAGES[k]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score int, key string, tokens int"
    rows = [(1, None, None, None, None, 1, "", 1), (2, "", "en", "s", 0, 1, "", 1), (2, "", "en", "s", 0, 1, "", 1),
            (3, "some words that are read here and there", "en", "s", 39, 1, "", 1), (None, "x", "de", None, 1, 1, "", 1),
            (4, "long text with words " * 20_000, "en", "t", 1, 1, "", 1)]
    df = spark.createDataFrame(rows, schema)
    for docs in (df, df.limit(0)):
        out = stage(spark, docs, SF_SMALL)
        got = out.collect()
        assert k == 3 or out.columns == df.columns
        assert len(got) <= len(rows)
    assert out.collect() == []


CLASHING = ["score", "predicted", "difference", "ratio", "product", "_row", "_others", "probability", "of_source",
            "of_lang", "of_topic", "topic", "tokens", "tree", "ids", "decoded", "key", "component_id", "mark", "n"]


@pytest.mark.parametrize("k", range(4))
def test_each_stage_keeps_the_values_of_clashing_columns(spark, k):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    more = docs.select("*", *[F.concat(F.lit(f"{c} "), F.col("doc_id").cast("string")).alias(c) for c in CLASHING])
    _, stage = corpus_pipeline.STAGES[k]
    plain, got = stage(spark, docs, SF_SMALL).collect(), stage(spark, more, SF_SMALL).collect()
    assert plain and sorted(r.doc_id for r in got) == sorted(r.doc_id for r in plain)
    assert all(r[c] == f"{c} {r.doc_id}" for r in got for c in CLASHING)
    rest = {r.doc_id: r for r in plain}
    assert all(r[c] == rest[r.doc_id][c] for r in got for c in plain[0].__fields__)


def test_results_take_the_place_of_columns_with_their_names(spark):
    df = spark.createDataFrame([(1, "some text", "mine", "mine", "mine")],
                               "doc_id long, text string, n_tokens string, ids_sha256 string, tree string")
    coded = corpus_pipeline.STAGES[3][1](spark, df, SF_SMALL)
    assert sorted(coded.columns) == ["decoded_sha256", "doc_id", "ids_sha256", "n_tokens", "tree"]
    assert (coded.first().n_tokens, coded.first().tree) == (2, "mine")
    state = token_counts.build_counts(df, *bpe.tokenizer())
    edits = F.array().cast(token_counts.EDITS).alias("edits")
    done = token_counts.apply_edits(state.select("*", edits), *bpe.tokenizer()).first()
    assert (done.n_tokens, done.ids_sha256) == (2, "mine")
    at_once = token_counts.edited_counts(df.select("*", edits), *bpe.tokenizer()).first()
    assert (at_once.n_tokens, at_once.tree) == (2, "mine")


def test_one_row_of_each_group_stays(spark):
    a, b, c = (" ".join(f"{w}{i}" for i in range(40)) for w in "abc")
    rows = [(None, a, "null id, unique"), (7, b, "x"), (7, b, "x"), (None, b, "x"), (3, b + " more", "least id"),
            (None, c, "x"), (None, c + " more", "x"), (9, "d " * 30, "one id"), (9, " ".join(map(str, range(30))), "other text"),
            (5, "", "x"), (5, None, "x"), (6, "", "no words"), (None, "", "no words, no id"), (None, "", "no words, no id")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, df, SF_SMALL).collect()
    named = sorted(r.source for r in got if r.source != "x")
    assert named == sorted(r[2] for r in rows if r[2] != "x")
    assert sorted((r.doc_id or 0, (r.text or "")[:2]) for r in got if r.source == "x") == [(0, "c0"), (5, "")]
