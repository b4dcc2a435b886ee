"""Document fingerprints by locally consistent parsing.

A text is a sequence of symbols, at first its code points. One level of parsing does this:

1. runs of one symbol become one symbol that names the symbol and the run's length, so neighbours differ;
2. deterministic coin tossing: a symbol's label is 2 i + (its bit i), with i the lowest bit in which it differs from
   the symbol before it. Labels of neighbours differ again, and after ``ROUNDS`` rounds they are tiny numbers;
3. a phrase starts at every label that is larger than both its neighbours, and at the text's start;
4. a phrase's name is a hash of its symbols in order. The names are the symbols of the next level.

Whether a phrase starts at a place depends on a few symbols around it only, never on its offset: two texts that share a
passage share all phrases inside it, but for a few at its ends, on every level. Levels go on until one symbol is left.

The fingerprint holds, of the distinct names from level ``FIRST_LEVEL`` on and the name of the whole text, every one
whose hash (40 bits, base64) is below ``SHARE`` of all hashes, and at least the ``KEPT`` least. A name is in or out by
its own hash, so a passage brings the same names into the fingerprint of every text that holds it, however long that
text is, and a fingerprint's size follows the text's. The likeness of two fingerprints is the share of common hashes
in their union, up to the bound below which both hold all names: an estimate of the names' Jaccard similarity.

Whole batches of texts are parsed in one go with numpy; a batch ends at ``BATCH_CHARS`` code points, so memory is
bounded by the larger of that and one text (about 60 bytes per code point).

Defined results: a null text is the empty text, whose fingerprint is the empty string. Two empty texts have likeness
1, an empty and another text 0. Equal texts have equal fingerprints.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm.common import partitions, table

FIRST_LEVEL = 2
#: share of the names that a fingerprint holds, and how many it holds at least
SHARE = 0.25
KEPT = 64
ROUNDS = 4
HASH_BYTES = 5
BATCH_CHARS = 1 << 20
#: hashes under this bound are in every fingerprint
BELOW = np.uint64(int(SHARE * (1 << 8 * HASH_BYTES)))

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_POWER = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def collapse_runs(sym: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Step 1. ``owner`` is the text of each symbol, ascending."""
    first = np.ones(len(sym), bool)
    first[1:] = (sym[1:] != sym[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(first)
    if len(at) == len(sym):
        return sym, owner
    length = np.diff(np.append(at, len(sym))).astype(np.uint64)
    sym = sym[at]
    runs = length > 1
    sym[runs] = mixed(sym[runs] + length[runs] * _POWER)
    return sym, owner[at]


def coin_labels(sym: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Step 2. ``start`` marks the first symbol of each text; its neighbour to the left is a fixed symbol."""
    labels, before_first = sym, np.uint64(0)
    for k in range(ROUNDS):
        before = np.empty_like(labels)
        before[1:] = labels[:-1]
        before[start] = before_first
        differ = labels ^ before
        low = np.bitwise_count((differ & -differ) - differ.dtype.type(1)).astype(np.uint8)
        bit = ((labels >> low.astype(labels.dtype)) & labels.dtype.type(1)).astype(np.uint8)
        labels, before_first = (low << np.uint8(1)) | bit, np.uint8(128 if k == 0 else 16)
    return labels


def phrase_starts(labels: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Step 3: places of local maxima and of text starts."""
    rising, falling = np.ones(len(labels), bool), np.ones(len(labels), bool)
    rising[1:] = (labels[1:] > labels[:-1]) | start[1:]
    falling[:-1] = (labels[:-1] > labels[1:]) | start[1:]
    return np.flatnonzero((rising & falling) | start)


def phrase_names(sym: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Step 4."""
    length = np.diff(np.append(at, len(sym)))
    inside = np.arange(len(sym)) - np.repeat(at, length)
    powers = np.cumprod(np.full(int(length.max()) + 1, _POWER, np.uint64))
    total = np.add.reduceat(mixed(sym) * powers[inside], at)
    names = mixed(total + length.astype(np.uint64))
    names[names == 0] = 1
    return names


def signatures(texts: list[str]) -> list[np.ndarray]:
    """Ascending hashes (uint64, of HASH_BYTES) that make each text's fingerprint."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    sym = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), size)
    hashes, owners, level = [], [], 0

    def keep(names: np.ndarray, of: np.ndarray) -> None:
        hashes.append(mixed(names + np.uint64(level)) >> np.uint64(64 - 8 * HASH_BYTES))
        owners.append(of)

    while len(sym):
        sym, owner = collapse_runs(sym, owner)
        start = np.ones(len(sym), bool)
        start[1:] = owner[1:] != owner[:-1]
        at = phrase_starts(coin_labels(sym, start), start)
        sym, owner, level = phrase_names(sym, at), owner[at], level + 1
        alone = np.bincount(owner, minlength=len(texts))[owner] == 1
        if level >= FIRST_LEVEL:
            keep(sym, owner)
        elif alone.any():
            keep(sym[alone], owner[alone])
        sym, owner = sym[~alone], owner[~alone]
    if not hashes:
        return [np.zeros(0, np.uint64) for _ in texts]
    h, of = np.concatenate(hashes), np.concatenate(owners)
    order = np.lexsort((h, of))
    h, of = h[order], of[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (of[1:] != of[:-1])
    h, of = h[new], of[new]
    ends = np.searchsorted(of, np.arange(len(texts) + 1))
    low = np.bincount(of[h < BELOW], minlength=len(texts))
    return [h[a:min(b, a + max(KEPT, n))] for a, b, n in zip(ends[:-1], ends[1:], low, strict=True)]


def to_string(signature: np.ndarray) -> str:
    raw = signature.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - HASH_BYTES:]
    return base64.b64encode(raw.tobytes()).decode()


def from_string(fingerprint: str) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(fingerprint), np.uint8).reshape(-1, HASH_BYTES)
    return np.pad(raw, ((0, 0), (8 - HASH_BYTES, 0))).copy().view(">u8").astype(np.uint64).ravel()


def covered(signature: np.ndarray) -> np.uint64:
    """The bound up to which a fingerprint holds every name of its text."""
    return np.uint64(1 << 8 * HASH_BYTES) if len(signature) < KEPT else max(BELOW, signature[-1])


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    bound = min(covered(a), covered(b))
    both = np.sort(np.concatenate([a[a <= bound], b[b <= bound]]))
    twice = int((both[1:] == both[:-1]).sum())
    return twice / (len(both) - twice)


def in_order(docs: DataFrame) -> DataFrame:
    """docs (doc_id long, text string) dealt to consecutive ranges of doc_id, one a partition and sorted; each
    partition also gets, marked ``ahead``, the document that follows its last one (for the last range: the first of
    all). One shuffle. Range bounds are ids that exist, from one aggregate over the ids; they are as many as
    partitions. Rows without doc_id go to any partition."""
    n = partitions(docs.sparkSession)
    cuts = [i / n for i in range(1, n)] or [0.5]
    found = docs.agg(F.percentile_approx("doc_id", cuts, 100 * n).alias("cuts"), F.min("doc_id").alias("least")).first()
    least = found["least"]
    bounds = np.array(sorted({c for c in found["cuts"] or () if c > least}), np.int64)

    @F.arrow_udf("int")
    def part_of(ids: pa.Array) -> pa.Array:
        known = np.asarray(ids.fill_null(0))
        return pa.array(np.searchsorted(bounds, known, "right").astype(np.int32), mask=np.asarray(ids.is_null()))

    @F.arrow_udf("boolean")
    def opens(ids: pa.Array) -> pa.Array:
        known = np.asarray(ids.fill_null(0))
        return pa.array(np.isin(known, bounds), mask=np.asarray(ids.is_null()))

    last = len(bounds)
    own = F.coalesce(part_of("doc_id"), F.pmod(F.xxhash64("text"), F.lit(last + 1)).cast("int"))
    starts = opens("doc_id")
    rows = docs.withColumn("own", own)
    ahead = (F.when(F.col("doc_id") == least, F.lit(last)).when(starts, F.col("own") - 1))
    dealt = rows.select("doc_id", "text", F.explode(F.array(
        F.struct(F.col("own").alias("part"), F.lit(False).alias("ahead")),
        F.struct(ahead.alias("part"), F.lit(True).alias("ahead")))).alias("to")).where("to.part is not null")
    return (dealt.select("doc_id", "text", "to.part", "to.ahead").repartitionById(last + 1, F.col("part"))
            .sortWithinPartitions("part", "ahead", "doc_id", "text"))


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for doc, text, part, ahead in zip(*batch.columns, strict=True):
            yield doc.as_py(), text.as_py() or "", part.as_py(), ahead.as_py()


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """docs (doc_id long, text string) with n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and
    near_next: the edited text is the text whose last quarter is replaced by the start of the next document's.

    Equal ids are ordered by text. A row without doc_id has no place in the order: its edited text only loses the
    quarter, and near_next is null. A single document is followed by itself."""
    fields = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
              ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()),
              ("near_next", pa.float64())]

    def work(rows: list[tuple], after: tuple | None) -> pa.RecordBatch:
        nexts = [*rows[1:], after]
        edited = []
        for (doc, text, _, _), then in zip(rows, nexts, strict=True):
            n = len(text) // 4
            edited.append(text[:len(text) - n] + (then[1][:n] if then and doc is not None else ""))
        whole = [r[1] for r in rows] + [after[1] if after else ""]
        marks = signatures(whole + edited)
        own, changed = marks[:len(whole)], marks[len(whole):]
        out = []
        for i, ((doc, text, _, _), then) in enumerate(zip(rows, nexts, strict=True)):
            out.append((doc, len(text), hashlib.sha256(edited[i].encode("utf-8", "surrogatepass")).hexdigest(),
                        to_string(own[i]), to_string(changed[i]), likeness(own[i], changed[i]),
                        likeness(own[i], own[i + 1]) if then and doc is not None else None))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*out, strict=True), fields,
                                                                               strict=True)],
                                          names=[n for n, _ in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, chars, done = [], 0, False
        for row in rows_of(batches):
            if held and row[2] != held[0][2]:  # the next range, where one task has several
                if not done:
                    yield work(held, None)
                held, chars, done = [], 0, False
            if done:  # further documents with the id of the one ahead
                continue
            if row[3] or chars + len(row[1]) > BATCH_CHARS:
                if held:
                    yield work(held, row)
                held, chars, done = [row], 0, row[3]
                chars = len(row[1])
                continue
            held.append(row)
            chars += len(row[1])
        if held and not done:
            yield work(held, None)

    return in_order(docs).mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                          "edited_fingerprint string, near_edited double, near_next double")


def op3_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(table(spark, sf_dir, "documents", "doc_id", "text"))
