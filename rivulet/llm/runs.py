"""Periodic runs of words, found in a grammar of the text.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) and at least
max(LEAST, TIMES * q) words that no neighbouring word extends keeping period q. ``find_runs`` compresses the word ids by
Re-Pair (the commonest pair of neighbouring symbols becomes a new nonterminal, until no pair occurs twice) and looks for
the runs that cross the boundary between a nonterminal's two halves, once per nonterminal, on one of its occurrences. A
balanced tree over the symbols that are left plays the nonterminals' part at the top. What is found goes to all places
where the nonterminal derives from (Re-Pair notes them as it replaces), and stretches of one period that overlap by a
period are merged. Every run lies whole in the lowest node that contains it, so none is missed; a stretch that its node
cuts off is merged into the whole one.

Across a boundary m a run of period q has words m and m + q, or words m - 1 - q and m - 1 (it has 3 q words). Both
alignments of all q of all nodes are compared at once: longest common extensions come from exact names of all stretches
of 2^k words.

Before that, words that can be in no run are left out: any stretch of GRAM = 9 words of a run comes again q words on,
inside the run (LEAST - 2 q + 1 >= 9 for q <= 8, q + 1 > 9 beyond), so a run lies inside a stretch of positions whose
9 words occur at least twice in the document. Only these stretches are compressed; hashes decide, and a collision can
only keep more.

Documents do not meet each other. Texts are handled in groups of about GROUP_BYTES of a batch; one text of any length is
never cut. Time and memory grow with a text's words times the logarithm of their number.

Defined results: a null or empty text has no words and no runs, and the hash of the empty text; equal texts give equal
runs; an empty table gives an empty result. Columns of the input other than those named are left behind, so their names
clash with nothing.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm.common import bound_batches, table
from rivulet.llm.shingles import mixed

#: least words and least repeats of a run
LEAST = 24
TIMES = 3
#: words of the stretches that come again inside any run
GRAM = 9
GROUP_BYTES = 4 << 20
#: alignments compared at once
ALIGNED = 1 << 21
#: ids of a group's words and nonterminals are below it
SPAN = 1 << 30

_STEPS = mixed(np.arange(1, GRAM + 1, dtype=np.uint64)) | np.uint64(1)


def re_pair(seq: np.ndarray, fresh: int) -> tuple[list[tuple[int, int, list[int]]], list[tuple[int, int]]]:
    """Rules (words of the left half, words, places) and the symbols left over (place, words) of the grammar of ``seq``.
    Ids from ``fresh`` on are free for nonterminals."""
    n = len(seq)
    if n < 2:
        return [], [(i, 1) for i in range(n)]
    sym, after, before = seq.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
    size = dict.fromkeys(sym, 1)
    places: dict[int, list[int]] = defaultdict(list)
    pair = seq[:-1].astype(np.int64) * SPAN + seq[1:]
    order = np.argsort(pair, kind="stable")
    begins = np.flatnonzero(np.diff(pair[order], prepend=-1))
    counts = np.diff(begins, append=n - 1)
    for b, c in zip(begins[counts > 1].tolist(), counts[counts > 1].tolist(), strict=True):
        places[int(pair[order[b]])] = order[b:b + c].tolist()
    by_count: dict[int, list[int]] = defaultdict(list)
    for p, at in places.items():
        by_count[len(at)].append(p)
    rules, count = [], max(by_count, default=0)
    while count > 1:
        if not by_count[count]:
            count -= 1
            continue
        p = by_count[count].pop()
        a, b = divmod(p, SPAN)
        at, free = [], 0
        for i in places.pop(p):
            if i >= free and sym[i] == a and after[i] < n and sym[after[i]] == b:
                at.append(i)
                free = after[i] + 1 if a == b else 0
        if len(at) < count:  # other pairs have taken some of its places
            if len(at) > 1:
                places[p] = at
                by_count[len(at)].append(p)
            continue
        new, fresh = fresh, fresh + 1
        size[new] = size[a] + size[b]
        rules.append((size[a], size[new], at))
        made = set()
        for i in at:
            j = after[i]
            k = after[j]
            sym[i], sym[j], after[i] = new, -1, k
            if k < n:
                before[k] = i
                q = new * SPAN + sym[k]
                places[q].append(i)
                made.add(q)
            if before[i] >= 0:
                q = sym[before[i]] * SPAN + new
                places[q].append(before[i])
                made.add(q)
        for q in made:
            if len(places[q]) > 1:
                by_count[len(places[q])].append(q)
            else:
                del places[q]
    left, i = [], 0
    while i < n:
        left.append((i, size[sym[i]]))
        i = after[i]
    return rules, left


def halves(at: list[int], low: int, high: int) -> Iterator[tuple[int, int, int]]:
    """(begin, middle, end) of the nodes of a balanced tree over symbols that begin at ``at``; its last entry ends."""
    todo = [(low, high)]
    while todo:
        low, high = todo.pop()
        if high - low > 1 and at[high] - at[low] >= LEAST:
            middle = (low + high) // 2
            yield at[low], at[middle], at[high]
            todo += [(low, middle), (middle, high)]


def names_of(words: np.ndarray, longest: int) -> list[np.ndarray]:
    """names[k][i]: equal for equal stretches of 2^k words (cut off by the end) and only for them."""
    names = [words.astype(np.int64)]
    while 2 << (len(names) - 1) <= longest:
        now, step = names[-1], 1 << (len(names) - 1)
        next_one = np.zeros(len(now), np.int64)
        next_one[:-step or None] = now[step:] + 1
        names.append(np.unique(now * (int(now.max()) + 2) + next_one, return_inverse=True)[1].astype(np.int64))
    return names


def extensions(names: list[np.ndarray], a: np.ndarray, b: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
    """How many words agree from a and b on, forward, or before a and b, backward; ``most`` at the most."""
    out = np.zeros(len(a), np.int64)
    for k in range(len(names) - 1, -1, -1):
        step = 1 << k
        i = np.flatnonzero(out + step <= most)
        x, y = (a[i] - out[i] - step, b[i] - out[i] - step) if back else (a[i] + out[i], b[i] + out[i])
        i = i[names[k][x] == names[k][y]]
        out[i] += step
    return out


def crossing(words: np.ndarray, names: list[np.ndarray], nodes: np.ndarray) -> np.ndarray:
    """Rows (node, begin, end, period): stretches of max(LEAST, TIMES * period) words that cross a node's middle, as
    long as the node allows; the least period only. ``nodes`` has rows (begin, middle, end)."""
    out = [np.zeros((0, 4), np.int64)]
    periods = (nodes[:, 2] - nodes[:, 0]) // TIMES
    totals = np.cumsum(periods)
    first = 0
    while first < len(nodes):
        done = totals[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(totals, done + ALIGNED, "right")))
        of = np.repeat(np.arange(first, last), periods[first:last])
        begin, middle, end = nodes[of].T
        q = np.arange(len(of)) - np.repeat(totals[first:last] - periods[first:last] - done, periods[first:last]) + 1
        first = last
        for left in (0, 1):  # words m and m + q are equal, or words m - 1 - q and m - 1
            at = middle - left * q
            probe = at - left
            fits = np.flatnonzero((probe >= begin) & (probe + q < end))
            fits = fits[words[probe[fits]] == words[probe[fits] + q[fits]]]
            x, step = at[fits], q[fits]
            back = extensions(names, x, x + step, x - begin[fits], True)
            ahead = extensions(names, x, x + step, end[fits] - x - step, False)
            length = back + step + ahead
            keep = length >= np.maximum(LEAST, TIMES * step)
            out.append(np.column_stack([of[fits], x - back, x + step + ahead, step])[keep])
    found = np.concatenate(out)
    found = found[np.lexsort((found[:, 3], found[:, 2], found[:, 1], found[:, 0]))]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:, :3] != found[:-1, :3]).any(axis=1)
    return found[new]


def merged(found: np.ndarray) -> list[tuple[int, int, int]]:
    """Runs (begin, end, least period) of stretches (begin, end, period): overlaps of a period are one stretch."""
    whole: dict[tuple[int, int], int] = {}
    begin = end = period = -1
    for b, e, q in [*found[np.lexsort((found[:, 0], found[:, 2]))].tolist(), (0, 0, -2)]:
        if q == period and b + q <= end:
            end = max(end, e)
            continue
        if period > 0:
            whole[begin, end] = min(period, whole.get((begin, end), period))
        begin, end, period = b, e, q
    return sorted((b, e, q) for (b, e), q in whole.items())


def repeated_stretches(words: np.ndarray, owner: np.ndarray) -> list[tuple[int, int]]:
    """(begin, end) of the stretches in which a run may lie: all their GRAM words occur again in the same document."""
    n = len(words) - GRAM + 1
    if n < 1:
        return []
    spread = mixed(words.astype(np.uint64) + np.uint64(1))
    total = np.zeros(n, np.uint64)
    for j in range(GRAM):
        total += spread[j:j + n] * _STEPS[j]
    total = mixed(total + mixed(owner[:n].astype(np.uint64) + np.uint64(1)))
    inside = owner[:n] == owner[GRAM - 1:]
    ordered = np.sort(total[inside])
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return []
    at = np.minimum(np.searchsorted(twice, total), len(twice) - 1)
    flag = np.concatenate([[False], inside & (twice[at] == total), [False]])
    edges = np.flatnonzero(flag[1:] != flag[:-1])
    begins, ends = edges[::2], edges[1::2] + GRAM - 1
    return [(int(b), int(e)) for b, e in zip(begins, ends, strict=True) if e - b >= LEAST]


def find_runs(documents: list[list]) -> list[list[tuple[int, int, int]]]:
    """Per document (a list of words) its runs (start, length, period), by start, then period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in documents]
    ids: dict = {}
    words = np.fromiter((ids.setdefault(w, len(ids)) for d in documents for w in d), np.int64,
                        sum(map(len, documents)))
    sizes = np.fromiter(map(len, documents), np.int64, len(documents))
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(documents)), sizes)
    stretches = repeated_stretches(words, owner)
    if not stretches:
        return out
    # all stretches in a row, each ended by a symbol that occurs nowhere else
    parts, origin, of, at = [], [], [], 0
    for k, (b, e) in enumerate(stretches):
        parts += [words[b:e], np.array([len(ids) + k])]
        origin.append(b - at)
        of.append(at)
        at += e - b + 1
    text = np.concatenate(parts)
    owners = owner[[b for b, _ in stretches]]
    nodes, places = [], []
    for first in np.flatnonzero(np.diff(owners, prepend=-1)):
        last = int(np.searchsorted(owners, owners[first], "right"))
        base, stop = of[first], of[last] if last < len(of) else at
        rules, left = re_pair(text[base:stop], len(ids) + len(stretches))
        for left_words, size, found in rules:
            if size >= LEAST:
                nodes.append((base + found[0], base + found[0] + left_words, base + found[0] + size))
                places.append(np.array(found) + base)
        chain = [base + i for i, _ in left] + [stop]
        bounds = [i for i, p in enumerate(chain[:-1]) if text[p] >= len(ids)]
        low = 0
        for high in bounds:
            for node in halves(chain, low, high):
                nodes.append(node)
                places.append(np.array(node[:1]))
            low = high + 1
    nodes = np.array(nodes, np.int64).reshape(-1, 3)
    if not len(nodes):
        return out
    found = crossing(text, names_of(text, int((nodes[:, 2] - nodes[:, 0]).max())), nodes)
    moved = [np.column_stack([places[i] + (b - nodes[i, 0]), places[i] + (e - nodes[i, 0]),
                              np.full(len(places[i]), q)]) for i, b, e, q in found.tolist()]
    for b, e, q in merged(np.concatenate([np.zeros((0, 3), np.int64), *moved])):
        k = int(np.searchsorted(of, b, "right")) - 1
        d = int(owners[k])
        out[d].append((b + origin[k] - int(starts[d]), e - b, q))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def repeat_tail(words: list, key: int | None) -> list:
    """``words`` as the query damages them: if crc32 of the decimal key is divisible by 10, a period from some word on
    is repeated to the end. A null key leaves them as they are."""
    h = None if key is None else crc32(str(key).encode())
    if h is None or h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * (-(-(n - a) // p)))[:n - a]


def collapsed(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words without those that a run contains after its first period."""
    if not runs:
        return words
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period:start + length] = False
    return [words[i] for i in np.flatnonzero(kept).tolist()]


def groups(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Index ranges of about GROUP_BYTES of texts."""
    first = total = 0
    for i, size in enumerate(sizes):
        total += size
        if total >= GROUP_BYTES or i + 1 == len(sizes):
            yield first, i + 1
            first, total = i + 1, 0


FIELDS = ("start", "length", "period")
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_RUNS = pa.list_(pa.struct([(n, pa.int64()) for n in FIELDS]))


def with_runs(df: DataFrame, damage: bool = False) -> DataFrame:
    """(doc_id, runs RUNS, collapsed binary) per row of ``df`` (doc_id, text): the runs of a text's words by start, then
    period, and the words that stay when repeats go, joined by one space. If ``damage``, ``repeat_tail`` first."""
    bound_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            texts = batch.column("text").cast(pa.binary())
            for low, high in groups(pc.coalesce(pc.binary_length(texts), 0).to_pylist()):
                keys = ids.slice(low, high - low)
                words = [(t or b"").split() for t in texts.slice(low, high - low).to_pylist()]
                if damage:
                    words = [repeat_tail(w, k) for w, k in zip(words, keys.to_pylist(), strict=True)]
                found = find_runs(words)
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array([[dict(zip(FIELDS, r, strict=True)) for r in runs] for runs in found], _RUNS),
                     pa.array([b" ".join(collapsed(w, r)) for w, r in zip(words, found, strict=True)], pa.binary())],
                    names=["doc_id", "runs", "collapsed"])

    return df.select("doc_id", "text").mapInArrow(
        run, f"doc_id {df.schema['doc_id'].dataType.simpleString()}, runs {RUNS}, collapsed binary")


def strongest(runs: Column) -> Column:
    """The run with the greatest exact length / period; ties: smallest start, then period (the order of ``runs``)."""
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    return F.aggregate(runs, none, lambda best, r: F.when(
        best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document after ``repeat_tail``: their number, the strongest one, digests of all runs and of the
    words that stay."""
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"],
                                                   F.lit("\n")))
    return (with_runs(table(spark, sf_dir, "documents", "doc_id", "text"), damage=True)
            .withColumn("best", strongest(F.col("runs")))
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), *[F.col(f"best.{n}").alias(n) for n in FIELDS],
                    F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                    F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
                    F.sha2("collapsed", 256).alias("collapsed_sha256")))
