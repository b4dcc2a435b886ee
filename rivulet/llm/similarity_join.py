"""N-gram Jaccard join with adaptive multi-match prefixes.

Two texts link when their sets of word shingles have a Jaccard similarity of at least ``percent`` / 100. If shingles
have one global order, such texts share at least l shingles within the first n - ceil(percent n / 100) + l of each
(n: the set's size), for any l. Every text picks its own l from 1 to ``MOST``: a longer prefix costs index rows, but asks
for more shared shingles before a pair is verified; the pick has the least estimated cost. A pair is a candidate if it
shares at least the smaller l of the two.

1. A sketch of ``CELLS`` counters holds how many sets have a shingle of each cell. It orders the shingles, rare first,
   and estimates how many candidates a prefix shingle brings. Its size is fixed; tasks add up counts before they move.
2. Texts with equal sets are one class from here on, stood for by the least id. Shingles that occur in the prefixes of
   one class only are dropped, before any row is moved where a bitmap of fixed size shows it.
3. Stars: each prefix shingle proposes pairs of one member and each other, a number of rows that is linear in the
   shingle's. Verified pairs make components. This joins large groups of near copies without all their pairs. The
   first round's middle is the text with the fewest rarer shingles, the next ones' is a member by hash, for open
   shingles (whose texts are still in several components), until a round finds nothing new.
4. What remains are pairs of texts of different components: all that share enough open prefix shingles, and that size,
   place and earlier open shingles of the shared ones allow, are verified. No pair is left out, and pairs within a
   component need no check.

Before their sets are moved, pairs are held against the sets' signs: parity bits, about one per shingle, that prove most
pairs of unlike texts too far apart. Verification intersects the whole sets of the others, which are made again from the
texts of a round's pairs alone. Components come from ``connected_components``.

Defined results: a null text is empty; an empty text, or one without words, has no shingles and links with nothing (its
component is its own id). Rows with equal ids count as one node. Rows whose id is null belong to the component of their
set's class, null if no member has an id. Other columns are dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from rivulet.llm.common import bound_batches, brief_shuffles, cut, packed, partitions, release, table
from rivulet.llm.components import connected_components
from rivulet.llm.shingles import groups, shingle_sets

WORDS = 5
PERCENT = 80
#: most shared prefix shingles that a text may ask for
MOST = 16
#: cost of one candidate, in prefix shingles
CANDIDATE_COST = 4.0
CELLS = 1 << 22
CHUNK = 1 << 14
#: bits of the bitmaps that rule out shingles (8 MB) and documents (1 MB)
TOKEN_BITS = 1 << 26
ID_BITS = 1 << 23
#: parity bits that a set is summed up in, as PARITY columns of 64 bits
PARITY = 4
#: longs that the open shingles of a text before one of them are summed up in, a parity bit for each bit
EARLIER = 4
#: star rounds at most; the last step does the rest in any case. Each further one reads all open postings again, and
#: after the first with its central texts there is next to nothing left to find
STARS = 1


def sketch(docs: DataFrame, words: int) -> np.ndarray:
    """How many of the texts' sets have a shingle in each cell: CELLS numbers, whatever the input."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(CELLS, np.int64)
        for _, texts in groups(batches):
            h, _ = shingle_sets(texts, words)
            np.add.at(cells, (h & np.uint64(CELLS - 1)).astype(np.int64), 1)
        yield from rows(dict(enumerate(cells.reshape(-1, CHUNK))))

    def numbers(v: bytes) -> np.ndarray:
        return np.frombuffer(v, "<i4" if len(v) == 4 * CHUNK else "<i8").astype(np.int64)

    def rows(chunks: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for k, v in chunks.items():  # a chunk at a time, so neither side of the pipe holds copies of all
            if v.any():
                cells = v.astype("<i4" if v.max() < 1 << 31 else "<i8").tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([cells], pa.binary())],
                                                 names=["chunk", "cells"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total[k] = total.get(k, 0) + numbers(v)
        yield from rows(total)

    schema = "chunk int, cells binary"
    n = min(partitions(docs.sparkSession), CELLS // CHUNK)
    with brief_shuffles(docs.sparkSession):
        parts = docs.select("text").mapInArrow(count, schema).repartition(n, "chunk").mapInArrow(add, schema).collect()
    wide = any(len(r["cells"]) > 4 * CHUNK for r in parts)
    cells = np.zeros((CELLS // CHUNK, CHUNK), np.int64 if wide else np.int32)
    for r in parts:
        cells[r["chunk"]] = numbers(r["cells"])
    return cells.ravel()


def choose_matches(excess: np.ndarray, bounds: np.ndarray, least: np.ndarray) -> np.ndarray:
    """The number of matches that each set asks for. ``excess``: estimated other sets with a shingle, in global order
    within bounds; ``least``: the prefix's length for one match."""
    size, total = np.diff(bounds), np.concatenate([[0.0], np.cumsum(excess)])
    best, cost = np.ones(len(size), np.int64), np.full(len(size), np.inf)
    for k in range(1, MOST + 1):
        length = least + k - 1
        there = (length <= size) & (size > 0)
        end = bounds[:-1] + np.minimum(length, size)
        now = np.where(there, length + CANDIDATE_COST * (total[end] - total[bounds[:-1]]) / k, np.inf)
        best[now < cost], cost = k, np.minimum(now, cost)
    return best


def prefixes(docs: DataFrame, cells: np.ndarray, words: int, percent: int) -> DataFrame:
    """doc_id, n (set size), s1 and s2 (128 bits that stand for the set), matches, prefix (shingles in global order),
    p0.. (PARITY columns: each bit says whether the set has an odd number of the shingles that hash to it), sign (the
    same with a bit or more per shingle, ``sign_words`` longs)."""
    shared = docs.sparkSession.sparkContext.broadcast(cells)
    load = cells.mean()
    noise = load + 3 * np.sqrt(load)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for batch, texts in groups(batches):
            h, bounds = shingle_sets(texts, words)
            size = np.diff(bounds)
            marks = [hashlib.md5(h[a:b].tobytes()).digest() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            s = np.frombuffer(b"".join(marks), "<i8").reshape(-1, 2)
            estimate = counts[(h & np.uint64(CELLS - 1)).astype(np.int64)]
            owner = np.repeat(np.arange(len(texts)), size)
            order = np.lexsort((h, estimate, owner))
            excess = np.maximum(estimate[order] - noise, 0.0)
            least = size - -(-percent * size // 100) + 1
            matches = choose_matches(excess, bounds, least)
            length = np.where(size > 0, np.minimum(least + matches - 1, size), 0)
            inside = np.arange(len(h)) - np.repeat(bounds[:-1], size)
            taken = h[order][inside < np.repeat(length, size)].astype(np.int64)
            ends = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
            width = 64 * PARITY
            bit = ((h >> np.uint64(24)) % np.uint64(width)).astype(np.int64)
            odd = np.bincount(owner * width + bit, minlength=len(texts) * width).reshape(-1, width) & 1
            parity = np.packbits(odd.astype(np.uint8), axis=1).view("<i8")
            signs, at = sign_bits(h, bounds)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(s[:, 0]), pa.array(s[:, 1]),
                 pa.array(matches, pa.int32()), pa.ListArray.from_arrays(pa.array(ends), pa.array(taken)),
                 *(pa.array(np.ascontiguousarray(parity[:, k])) for k in range(PARITY)),
                 pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(signs))],
                names=["doc_id", "n", "s1", "s2", "matches", "prefix", *parities(), "sign"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n long, s1 long, s2 long, matches int, prefix array<long>, "
             + ", ".join(f"{p} long" for p in parities()) + ", sign array<long>")


def sign_words(size: np.ndarray) -> np.ndarray:
    """Longs of the sign of a set: a power of two, at least PARITY, with a bit per shingle."""
    return np.maximum(PARITY, 1 << np.ceil(np.log2(np.maximum(size, 1) / 64)).clip(0).astype(np.int64))


def sign_bits(h: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(longs, bounds) of the sets' signs. A sign of twice as many longs, halves XORed, is that of the shorter length."""
    size = np.diff(bounds)
    longs = sign_words(size)
    at = np.concatenate([[0], np.cumsum(longs)])
    bit = (h >> np.uint64(24)).astype(np.int64) & np.repeat(64 * longs - 1, size)
    odd = np.bincount(np.repeat(64 * at[:-1], size) + bit, minlength=64 * at[-1]) & 1
    return np.packbits(odd.astype(np.uint8)).view("<i8"), at


def parities() -> list[str]:
    return [f"p{k}" for k in range(PARITY)]


def earlier() -> list[str]:
    return [f"e{k}" for k in range(EARLIER)]


def bit_words(values: DataFrame, bits: int) -> DataFrame:
    """(word, bits): the words with set bits of a bitmap of ``bits`` bits in 64-bit words, in which the rows' one column
    (long, a hash) sets bits; at most bits / 64 rows."""
    word, bit = place(F.col(values.columns[0]), bits)
    return values.select(word.alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))


def place(mark: Column, bits: int) -> tuple[Column, Column]:
    """(word, bit): where a hash has its bit."""
    at = F.pmod(mark, F.lit(bits))
    return F.floor(at / 64), F.call_function("shiftleft", F.lit(1).cast("long"), (at % 64).cast("int"))


def bitmap(values: DataFrame, bits: int) -> np.ndarray:
    """``bit_words`` as an array, on the driver."""
    with brief_shuffles(values.sparkSession):
        words = bit_words(values, bits).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy()
    return out.view(np.uint64)


def bit_set(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = np.mod(hashes.astype(np.int64), 64 * len(bits))
    return (bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1


def postings(rows: DataFrame) -> DataFrame:
    """(token, doc_id, pos, n, matches) for prefix shingles that occur in the prefixes of at least two classes, one
    member (the least id) per class."""
    tokens = (rows.select(F.explode("prefix").alias("token"), "s1").groupBy("token")
              .agg(F.min("s1").alias("low"), F.max("s1").alias("high")).where("low <> high").select("token"))
    tokens = cut(tokens, "join-tokens")
    shared = rows.sparkSession.sparkContext.broadcast(bitmap(tokens, TOKEN_BITS))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prefix = batch.column("prefix")
            ends = np.asarray(prefix.offsets)
            flat = np.asarray(prefix.values)[ends[0]:ends[-1]]
            size = np.diff(ends)
            row = np.repeat(np.arange(len(size)), size)
            kept = np.flatnonzero(bit_set(shared.value, flat))
            take = pa.array(row[kept])
            pos = kept - (ends[:-1] - ends[0])[row[kept]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(flat[kept]), batch.column("doc_id").take(take), pa.array(pos, pa.int32()),
                 batch.column("n").take(take), batch.column("matches").take(take)],
                names=["token", "doc_id", "pos", "n", "matches"])

    named = rows.where("n > 0 and doc_id is not null").select("doc_id", "n", "matches", "prefix")
    least = cut(classes(rows).select("doc_id").distinct(), "join-classes")
    copies = cut(named.select("doc_id").join(least, "doc_id", "left_anti").distinct(), "join-copies")
    found = without(named, "doc_id", copies).mapInArrow(run, f"token long, doc_id {kind}, pos int, n long, matches int")
    posts = cut(found.join(tokens, "token", "left_semi"), "join-postings")
    release(tokens, least, copies)
    shared.destroy()
    return posts


def without(rows: DataFrame, key: str, gone: DataFrame) -> DataFrame:
    """The rows whose key is not in gone (key). Only rows that a bitmap of fixed size cannot clear are moved."""
    words = F.broadcast(bit_words(gone.select(F.xxhash64(key).alias("mark")), ID_BITS))
    word, bit = place(F.xxhash64(key), ID_BITS)
    marked = rows.withColumn("_word", word).join(words, F.col("_word") == F.col("word"), "left")
    clear = F.coalesce(F.col("bits").bitwiseAND(bit), F.lit(0)) == 0
    return (marked.where(clear).select(rows.columns)
            .unionByName(marked.where(~clear).select(rows.columns).join(gone, key, "left_anti").select(rows.columns)))


def classes(rows: DataFrame) -> DataFrame:
    """(s1, s2, doc_id): the least id of each set's class."""
    return rows.where("n > 0").groupBy("s1", "s2").agg(F.min("doc_id").alias("doc_id")).where("doc_id is not null")


def sets_of(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """(doc_id, shingles array<long>) of the documents named in ids (doc_id). Only their texts go to the shingling, and
    only their sets are moved, but for the few that a bitmap of fixed size cannot rule out."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    # a broadcast of at most ID_BITS / 64 rows, so no second Python process per task holds texts back
    words_of = F.broadcast(bit_words(ids.select(F.xxhash64("doc_id").alias("mark")), ID_BITS))
    word, bit = place(F.xxhash64("doc_id"), ID_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in groups(batches):
            h, bounds = shingle_sets(texts, words)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)),
                                                                 pa.array(h.astype(np.int64)))],
                names=["doc_id", "shingles"])

    found = (docs.where("doc_id is not null").join(words_of, word == F.col("word"))
             .where(F.col("bits").bitwiseAND(bit) != 0).select("doc_id", "text").mapInArrow(
                 run, f"doc_id {kind}, shingles array<long>"))
    return found.join(ids, "doc_id", "left_semi")


def alike(size: Column, other: Column, shared: Column, percent: int) -> Column:
    """Whether sets of these sizes that share so many shingles are similar enough."""
    return 100 * shared >= percent * (size + other - shared)


def differing(columns: list[str]) -> Column:
    """Parity bits that differ between x and y: their sets differ in one shingle at least for each."""
    return sum((F.bit_count(F.col(f"x.{p}").bitwiseXOR(F.col(f"y.{p}"))) for p in columns), F.lit(0))


def shared_before() -> Column:
    """At most so many shingles two texts share before a token of both prefixes: such are in both prefixes, so open, and
    parity bits show some open ones that only one text has."""
    both = F.col("x.before") + F.col("y.before") - differing(earlier())
    return F.least("x.before", "y.before", F.floor(both / 2))


def possible(percent: int) -> Column:
    """Of a pair of postings x and y with one token: whether sizes, places and parity bits leave room for enough shared
    shingles. What two texts share before the token is bounded by ``shared_before``; from the token on they share at
    most what either still has; and they differ in one shingle at least for each parity bit that differs."""
    need = F.ceil(percent * (F.col("x.n") + F.col("y.n")) / (100 + percent))
    here = shared_before() + F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos"))
    return ((F.least("x.n", "y.n") >= need) & (differing(parities()) <= F.col("x.n") + F.col("y.n") - 2 * need)
            & (here >= need))


def not_far(pairs: DataFrame, marks: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that their signs leave possible: sets differ in one shingle at least for each bit that differs.
    ``possible`` has passed them, so the longer sign has at most twice the longs of the other."""
    both = pairs
    for side in "ab":
        both = both.join(marks.select(F.col("doc_id").alias(side), F.col("n").alias(f"n_{side}"),
                                      F.col("sign").alias(f"sign_{side}")), side)
    short = F.least(F.size("sign_a"), F.size("sign_b"))

    def folded(sign: str) -> Column:
        halves = F.zip_with(F.slice(sign, F.lit(1), short), F.slice(sign, short + 1, short), lambda p, q: p.bitwiseXOR(q))
        return F.when(F.size(sign) > short, halves).otherwise(F.col(sign))

    differ = F.aggregate(F.zip_with(folded("sign_a"), folded("sign_b"), lambda p, q: F.bit_count(p.bitwiseXOR(q))),
                         F.lit(0), lambda total, one: total + one)
    size = F.col("n_a") + F.col("n_b")
    return both.where(differ <= size - 2 * F.ceil(percent * size / (100 + percent))).select("a", "b").distinct()


def verified(pairs: DataFrame, marks: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) that link, by their whole sets."""
    first = cut(pairs, "join-pairs")
    pairs = cut(not_far(first, marks, percent), "join-near")
    ids = cut(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "join-ids")
    sets = cut(sets_of(docs, ids, words), "join-sets")
    release(first, ids)
    x = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x"))
    y = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y"))
    both = pairs.join(x, "a").join(y, "b")
    out = cut(both.where(alike(F.size("x"), F.size("y"), F.size(F.array_intersect("x", "y")), percent))
              .select("a", "b").distinct(), "join-links")
    release(pairs, sets)
    return out


def opened(posts: DataFrame, component: DataFrame | None, marks: DataFrame, percent: int) -> DataFrame:
    """posts of the tokens whose texts are in two or more components so far (part), with main (whether the text is in
    the component that has most of the token's texts), before (open shingles of the text before this one), e0.. (EARLIER
    columns of their parity bits), index (the prefix length that is enough for the smaller set of a pair) and the parity
    columns of the whole set. Without components each text is its own part, so all tokens are open and none has a main
    part."""
    if component is None:
        here = posts.withColumns({"part": F.col("doc_id"), "main": F.lit(False)})
        written = []
    else:
        now = cut(posts.join(component, F.col("doc_id") == F.col("id"), "left").select(
            *posts.columns, F.coalesce("component", "doc_id").alias("part")), "join-parts")
        by_part = now.groupBy("token", "part").agg(F.count("*").alias("texts"))
        tokens = cut(by_part.groupBy("token").agg(F.count("*").alias("parts"), F.max(F.struct("texts", "part"))
                                                  .alias("most"))
                     .where("parts > 1").select("token", F.col("most.part").alias("most")), "join-open")
        here = now.join(tokens, "token").withColumn("main", F.col("part") == F.col("most")).drop("most")
        written = [now, tokens]
    in_text = W.partitionBy("doc_id", "n").orderBy("pos")
    so_far = in_text.rowsBetween(W.unboundedPreceding, W.currentRow)
    word, bit = place(F.col("token"), 64 * EARLIER)
    own = [F.when(word == k, bit).otherwise(F.lit(0).cast("long")) for k in range(EARLIER)]
    left = here.join(marks.select("doc_id", "n", *parities()), ["doc_id", "n"])
    out = cut(left.withColumns({
        "before": F.row_number().over(in_text) - 1,
        **{e: F.bit_xor(b).over(so_far).bitwiseXOR(b) for e, b in zip(earlier(), own, strict=True)},
        "index": F.col("n") - F.ceil(2 * percent * F.col("n") / (100 + percent)) + F.col("matches")}),
        "join-open-postings")
    release(*written)
    return out


def pair_of(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def middles(left: DataFrame, marks: DataFrame, turn: int) -> DataFrame:
    """Per token, the posting of one text: first of the text with the fewest rarer shingles, which of near copies is the
    one with the fewest edits, so that most others link with it. Its parity columns come after the choice: they are most
    of a row's bytes."""
    order = F.col("pos").cast("long") if turn == 0 else F.xxhash64("token", "doc_id", F.lit(turn))
    held = ["doc_id", "part", "pos", "n", "before", *earlier()]
    least = F.min(F.struct(order.alias("order"), *held)).alias("y")
    return cut(left.groupBy("token").agg(least).select("token", *[f"y.{c}" for c in held])
               .join(marks.select("doc_id", "n", *parities()), ["doc_id", "n"]), "join-middles")


def star_pairs(left: DataFrame, middle: DataFrame, percent: int) -> DataFrame:
    """Per token, one text as the middle with each text of another component."""
    return (left.alias("x").join(middle.alias("y"), "token")
            .where((F.col("x.part") != F.col("y.part")) & possible(percent))
            .select(*pair_of("x.doc_id", "y.doc_id")).distinct())


def open_matches(left: DataFrame, percent: int) -> DataFrame:
    """(a, b, asked) for each open prefix shingle that two texts of different components share. A token's texts of its
    main component are compared with the others, not with each other."""
    smaller = F.struct("x.n", "x.doc_id") < F.struct("y.n", "y.doc_id")
    early = F.when(smaller, F.col("x.pos") < F.col("x.index")).otherwise(F.col("y.pos") < F.col("y.index"))
    once = F.col("y.main") | (F.col("x.doc_id") < F.col("y.doc_id"))
    both = left.where("not main").alias("x").join(left.alias("y"), (F.col("x.token") == F.col("y.token")) & once & early
                                                  & (F.col("x.part") != F.col("y.part")) & possible(percent))
    return both.select(*pair_of("x.doc_id", "y.doc_id"), F.least("x.matches", "y.matches").alias("asked"))


def open_pairs(left: DataFrame, percent: int) -> DataFrame:
    """All candidates of different components, once each."""
    return (open_matches(left, percent).groupBy("a", "b")
            .agg(F.count("*").alias("shared"), F.min("asked").alias("asked")).where("shared >= asked").select("a", "b"))


def links(docs: DataFrame, posts: DataFrame, marks: DataFrame, words: int, percent: int) -> DataFrame | None:
    """(id, component) of the classes that link with another one; None if there are none."""
    component, found, turn, last = None, None, 0, False
    while True:
        left = opened(posts, component, marks, percent)
        new = None
        if turn < STARS:
            middle = middles(left, marks, turn)
            new = verified(star_pairs(left, middle, percent), marks, docs, words, percent)
            release(middle)
            turn = STARS if new.isEmpty() else turn + 1
        if new is None or new.isEmpty():
            last, new = True, verified(open_pairs(left, percent), marks, docs, words, percent)
        release(left)
        if not new.isEmpty():
            found = new if found is None else found.unionByName(new)
            component = connected_components(found)
        if last:
            return component


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """docs (doc_id, text) to doc_id, n_shingles, component_id: one row per input row."""
    bound_batches(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    whole = cut(prefixes(docs, sketch(docs, words), words, percent), "join-prefixes")
    posts = postings(whole)
    named = cut(posts.select("doc_id").distinct(), "join-ids")
    marks = cut(whole.join(named, "doc_id", "left_semi").select("doc_id", "n", *parities(), "sign").distinct(),
                "join-marks")
    rows = cut(whole.select("doc_id", "n", "s1", "s2"), "join-sizes")
    release(whole, named)
    component = links(docs, posts, marks, words, percent)
    by_set = classes(rows)
    if component is None:
        by_set = by_set.withColumn("of_class", F.col("doc_id"))
    else:
        by_set = by_set.join(component, F.col("doc_id") == F.col("id"), "left").withColumn(
            "of_class", F.coalesce("component", "doc_id"))
    by_set = cut(by_set.select("s1", "s2", "of_class"), "join-classes")
    release(posts, marks)
    own = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("of_class"))
    return rows.select("doc_id", "n", "s1", "s2").join(by_set, ["s1", "s2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def op9_similarity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


def dedupe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group stays: the one with the least id, nulls last, then the least row number.

    Rows are numbered as they are written, and groups are made of rows, not of ids: a row without id is in the group of
    its text like any other, rows with one id and unlike texts are groups of their own. Rows whose texts have no words
    link with nothing, but rows with one id and one such text are copies (a null text is empty)."""
    rows, back = packed(docs, "doc_id", "text")
    rows = cut(rows.withColumn("_row", F.monotonically_increasing_id()), "join-rows")
    found = near_duplicates(rows.select(F.col("_row").alias("doc_id"), "text")).select(
        F.col("doc_id").alias("_row"), "n_shingles", "component_id")
    mark = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    wordless = (F.col("n_shingles") == 0) & F.col("doc_id").isNotNull()
    group = [F.when(wordless, F.col("doc_id")).alias("id"), F.when(wordless, F.col("mark")).alias("mark"),
             F.when(~wordless, F.col("component_id")).alias("component")]
    least = F.min(F.struct(F.col("doc_id").isNull().alias("null_id"), "doc_id", "_row")).alias("least")
    kept = cut(rows.select("_row", "doc_id", mark.alias("mark")).join(found, "_row").groupBy(*group).agg(least)
               .select("least._row"), "join-kept")
    copies = cut(rows.select("_row").join(kept, "_row", "left_anti"), "join-copies")
    release(kept)
    return without(rows, "_row", copies).select(*back)
