"""Edit-aware token counts: a segment tree of pre-token counts per document, updated where an edit touches the text.

``build_counts`` splits a text into pre-tokens and keeps, per document, the pre-tokens' ends and a segment tree over
blocks of ``LEAF`` pre-tokens whose nodes hold sums of tokens and of code points. ``apply_edits`` replaces the code
points [start, start + deleted) by new text. It goes back to the last pre-token that the edit cannot have changed,
re-encodes from there until a new pre-token ends where an old one did, past the edit, and keeps everything after
that; only the leaves over the changed pre-tokens and the sums above them are computed again (all leaves from the first
changed one on are re-dealt if the number of pre-tokens changed, from kept counts, without re-encoding).

Why that is exact: a pre-token is matched from its first character on, and the pattern looks at most two characters
past a pre-token's end (a run of white space gives its last character to what follows). So a pre-token that ends two
characters before an edit stays, and once a new end meets an old one behind the edit, both texts go on alike.

Defined results: null texts are empty and have no pre-tokens and 0 tokens. Edits are clipped to the text; a null edit
list changes nothing; edits of one document are applied in order, each to the result of the one before. Rows do not
meet each other, so repeated rows give equal results. Other columns are kept, but for
those named like a result, which takes their place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm.bpe import KEPT_WORDS, fold, load_ranks, splitter, tokenizer
from rivulet.llm.common import bound_batches, extended, table, widened

#: pre-tokens under one leaf of the tree
LEAF = 32
#: how far past its end a pre-token's match looks
LOOK = 2

#: columns of a document's state, little-endian: ends of pre-tokens (code points) and their token counts as 32-bit
#: integers, the tree as 64-bit integers
STATE = {"ends": "<i4", "counts": "<i4", "tree": "<i8"}
EDITS = "array<struct<start:int,deleted:int,inserted:string>>"


class Counter(dict):
    """word -> number of its tokens."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks

    def __missing__(self, word: str) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        self[word] = n = len(fold(word.encode("utf-8"), self.ranks))
        return n


def grow(sums: np.ndarray) -> np.ndarray:
    """A segment tree in one array: the root at 1, the children of i at 2 i and 2 i + 1, leaves at the end."""
    width = 1 << (len(sums) - 1).bit_length()
    levels = [np.pad(sums, (0, width - len(sums)))]
    while len(levels[-1]) > 1:
        levels.append(levels[-1].reshape(-1, 2).sum(axis=1))
    return np.concatenate([np.zeros(1, np.int64), *levels[::-1]])


def leaf_sums(counts: np.ndarray, first: int = 0, last: int | None = None) -> np.ndarray:
    """Sums of the leaves first..last (all), 0 for a leaf without pre-tokens."""
    leaves = max(1, -(-len(counts) // LEAF))
    last = leaves - 1 if last is None else last
    part = counts[first * LEAF:(last + 1) * LEAF].astype(np.int64)
    return np.pad(part, (0, (last - first + 1) * LEAF - len(part))).reshape(-1, LEAF).sum(axis=1)


class Counted:
    """A text with the ends of its pre-tokens, their token counts and the tree of sums."""

    def __init__(self, text: str, ends: np.ndarray, counts: np.ndarray, tree: np.ndarray):
        self.text, self.ends, self.counts, self.tree = text, ends, counts, tree
        self.encoded = 0

    @classmethod
    def build(cls, text: str, split, counter: Counter) -> Counted:
        words = split.findall(text)
        ends = np.cumsum(np.fromiter(map(len, words), "<i4", len(words)), dtype="<i4")
        counts = np.fromiter(map(counter.__getitem__, words), "<i4", len(words))
        return cls(text, ends, counts, grow(leaf_sums(counts)))

    @property
    def total(self) -> int:
        return int(self.tree[1])

    def edit(self, start: int, deleted: int, inserted: str, split, counter: Counter) -> None:
        old, size = self.ends, len(self.text)
        start = min(max(start, 0), size)
        stop = min(start + max(deleted, 0), size)
        shift = len(inserted) - (stop - start)
        text = self.text[:start] + inserted + self.text[stop:]
        first = int(np.searchsorted(old, start - LOOK, "right"))
        at = int(old[first - 1]) if first else 0
        ends, counts, last = [], [], len(old)
        for found in split.finditer(text, at):
            self.encoded += len(found[0])
            ends.append(found.end())
            counts.append(counter[found[0]])
            before = found.end() - shift
            if before >= stop:
                k = int(np.searchsorted(old, before))
                if k < len(old) and old[k] == before:
                    last = k + 1
                    break
        same = last - first == len(ends)
        self.text = text
        self.ends = np.concatenate([old[:first], np.array(ends, "<i4"), old[last:] + np.int32(shift)])
        self.counts = np.concatenate([self.counts[:first], np.array(counts, "<i4"), self.counts[last:]])
        self._update(first, last, same)

    def _update(self, first: int, last: int, same: bool) -> None:
        width = len(self.tree) // 2
        if -(-len(self.counts) // LEAF) > width:
            self.tree = grow(leaf_sums(self.counts))
            return
        low = min(first // LEAF, width - 1)
        high = min((max(last, first + 1) - 1) // LEAF, width - 1) if same else width - 1
        self.tree = self.tree.copy()
        self.tree[width + low:width + high + 1] = leaf_sums(self.counts, low, high)
        low, high = (width + low) // 2, (width + high) // 2
        while low:
            self.tree[low:high + 1] = self.tree[2 * low:2 * high + 2].reshape(-1, 2).sum(axis=1)
            low, high = low // 2, high // 2


def state_arrays(done: list[Counted]) -> dict[str, pa.Array]:
    return {name: pa.array([np.asarray(getattr(d, name), kind).tobytes() for d in done], pa.binary())
            for name, kind in STATE.items()}


def build_counts(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """``df`` (with column text) and its STATE columns, in place of any of these names."""
    df = df.drop(*STATE)
    bound_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast((load_ranks(path), pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, by = shared.value
        split, counter = splitter(by), Counter(ranks)
        for batch in batches:
            done = [Counted.build(t.as_py() or "", split, counter) for t in batch.column("text")]
            yield extended(batch, **state_arrays(done))

    return df.mapInArrow(run, widened(df.schema, **dict.fromkeys(STATE, "binary")))


def apply_edits(state: DataFrame, path: str, pattern: str) -> DataFrame:
    """Rows of ``build_counts`` with a column edits (EDITS): text and STATE after the edits, n_tokens_before, n_tokens,
    and encoded_chars, the code points that were encoded again. The column edits goes, and columns of the result's
    names are replaced."""
    shared = state.sparkSession.sparkContext.broadcast((load_ranks(path), pattern))
    changed = ("text", *STATE, "edits", "n_tokens_before", "n_tokens", "encoded_chars")
    kept = [c for c in state.columns if c not in changed]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, by = shared.value
        split, counter = splitter(by), Counter(ranks)
        for batch in batches:
            done, before = [], []
            for text, edits, *state_of in zip(*(batch.column(c) for c in ("text", "edits", *STATE)), strict=True):
                d = Counted(text.as_py() or "", *(np.frombuffer(x.as_py(), kind)
                                                  for x, kind in zip(state_of, STATE.values(), strict=True)))
                before.append(d.total)
                for e in edits.as_py() or ():
                    if e is not None:
                        d.edit(e["start"] or 0, e["deleted"] or 0, e["inserted"] or "", split, counter)
                done.append(d)
            out = batch.select(kept)
            yield extended(out, text=pa.array([d.text for d in done], pa.string()), **state_arrays(done),
                           n_tokens_before=pa.array(before, pa.int64()),
                           n_tokens=pa.array([d.total for d in done], pa.int64()),
                           encoded_chars=pa.array([d.encoded for d in done], pa.int64()))

    schema = widened(state.select(*kept).schema, text="string", **dict.fromkeys(STATE, "binary"),
                     n_tokens_before="long", n_tokens="long", encoded_chars="long")
    return state.mapInArrow(run, schema)


def edited_counts(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """``build_counts`` and ``apply_edits`` of rows (text, edits, and others that stay) at one go: n_tokens_before,
    n_tokens, encoded_chars and n_chars after the edits, in place of any columns of these names. The states pass in
    memory and are not returned."""
    bound_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast((load_ranks(path), pattern))
    kept = [c for c in df.columns if c not in ("text", "edits", *EDITED)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, by = shared.value
        split, counter = splitter(by), Counter(ranks)
        for batch in batches:
            found = []
            for text, edits in zip(batch.column("text"), batch.column("edits"), strict=True):
                d = Counted.build(text.as_py() or "", split, counter)
                before = d.total
                for e in edits.as_py() or ():
                    if e is not None:
                        d.edit(e["start"] or 0, e["deleted"] or 0, e["inserted"] or "", split, counter)
                found.append((before, d.total, d.encoded, len(d.text)))
            columns = [pa.array(c, pa.int64()) for c in zip(*found, strict=True)] or [pa.array([], pa.int64())] * 4
            yield extended(batch.select(kept), **dict(zip(EDITED, columns, strict=True)))

    return df.mapInArrow(run, widened(df.select(*kept).schema, **dict.fromkeys(EDITED, "long")))


EDITED = ("n_tokens_before", "n_tokens", "encoded_chars", "n_chars")


def two_edits(text: Column) -> Column:
    """The edits that the query makes in a text of n code points: at n/3, n/50 code points are replaced by the text's
    first n/100; then, at a tenth, one word is put in."""
    n = F.char_length(text)
    at = lambda part: F.floor(n / part).cast("int")
    edit = lambda start, deleted, inserted: F.struct(start.alias("start"), deleted.alias("deleted"),
                                                     inserted.alias("inserted"))
    return F.array(edit(at(3), at(50), F.substr(text, F.lit(1), at(100))),
                   edit(at(10), F.lit(0), F.lit(" edited")))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token count before and after two edits."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    return edited_counts(docs.withColumn("edits", two_edits(F.col("text"))), *tokenizer()).select("doc_id", *EDITED)
