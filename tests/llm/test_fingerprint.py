import hashlib
import random

import numpy as np
import pytest

from conftest import SF_SMALL
from rivulet.llm import fingerprint as P

MASK = (1 << 64) - 1


def mixed(x):
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & MASK
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & MASK
    return x ^ (x >> 31)


def parse(sym):
    """One level of the parsing, symbol by symbol: the phrases as (start, end) and their names."""
    runs = []
    for s in sym:
        if runs and runs[-1][0] == s:
            runs[-1][1] += 1
        else:
            runs.append([s, 1])
    sym = [s if n == 1 else mixed((s + n * 0x9E3779B97F4A7C15) & MASK) for s, n in runs]
    labels, first = sym, 0
    for k in range(P.ROUNDS):
        new = []
        for i, x in enumerate(labels):
            differ = x ^ (labels[i - 1] if i else first)
            low = (differ & -differ).bit_length() - 1
            new.append(2 * low + (x >> low & 1))
        labels, first = new, 128 if k == 0 else 16
    at = [i for i, x in enumerate(labels) if i == 0 or ((labels[i - 1] < x) and (i == len(sym) - 1 or labels[i + 1] < x))]
    names = []
    for a, b in zip(at, [*at[1:], len(sym)]):
        total, power = 0, 0x9E3779B97F4A7C15
        for s in sym[a:b]:
            total, power = (total + mixed(s) * power) & MASK, power * 0x9E3779B97F4A7C15 & MASK
        names.append(mixed((total + b - a) & MASK) or 1)
    return names


def signature(text):
    sym, level, found = [ord(c) + 1 for c in text], 0, set()
    while sym:
        sym, level = parse(sym), level + 1
        if level >= P.FIRST_LEVEL or len(sym) == 1:
            found |= {mixed((n + level) & MASK) >> (64 - 8 * P.HASH_BYTES) for n in sym}
        if len(sym) == 1:
            break
    return sorted(found)[:max(P.KEPT, sum(h < P.SHARE * 2 ** (8 * P.HASH_BYTES) for h in found))]


def texts():
    rng = random.Random(2)
    yield from ["", "a", "aa", "ab", "aaaaab", "😀é", "x" * 5000, "ab" * 3000, "\x00\x00\x01"]
    for _ in range(60):
        yield "".join(rng.choice("abcdé 中\n") for _ in range(rng.choice([3, 30, 700, 4000])))


def test_signatures_match_brute_force():
    all_texts = list(texts())
    for text, got in zip(all_texts, P.signatures(all_texts)):
        assert got.tolist() == signature(text)


def test_no_text_depends_on_its_neighbours_in_the_batch():
    all_texts = list(texts())
    for text, got in zip(all_texts, P.signatures(all_texts)):
        assert got.tolist() == P.signatures([text])[0].tolist()


@pytest.mark.parametrize("before,after", [(1, 200), (2, 200), (3, 200), (50, 200), (1111, 200), (5003, 300_000)])
def test_equal_passages_share_interior_names_at_any_offset_and_in_any_length(before, after):
    rng = random.Random(4)
    word = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = word(9000)
    bound = int(P.BELOW)
    alone = {h for h in P.signatures([passage])[0].tolist() if h < bound}
    inside = set(P.signatures([word(before) + passage + word(after)])[0].tolist())
    assert len(alone) > P.KEPT and len(alone & inside) > 0.9 * len(alone)


def test_likeness_estimates_shared_names():
    a, b = np.array([1, 2, 3], np.uint64), np.array([2, 3, 4], np.uint64)
    assert P.likeness(a, b) == 0.5 and P.likeness(a, a) == 1
    none = np.zeros(0, np.uint64)
    assert P.likeness(none, none) == 1 and P.likeness(a, none) == 0
    assert P.from_string(P.to_string(b)).tolist() == b.tolist()
    rng = np.random.RandomState(3)
    names = np.unique(rng.randint(0, 1 << 8 * P.HASH_BYTES, 9000).astype(np.uint64))
    rng.shuffle(names)
    held = lambda x: np.sort(x)[:max(P.KEPT, int((x < P.BELOW).sum()))]
    for x, y in ((names[:4000], names[1000:5000]), (names[:4000], names[3950:4010]), (names[:100], names[50:150])):
        u, v = held(x), held(y)
        bound = min(2 ** 40 if len(s) < P.KEPT else max(int(P.BELOW), int(s[-1])) for s in (u, v))
        low = lambda s: {h for h in s.tolist() if h <= bound}
        assert P.likeness(u, v) == len(low(x) & low(y)) / len(low(x) | low(y))
    assert abs(P.likeness(held(names[:4000]), held(names[1000:5000])) - 0.6) < 0.05


def expected(rows):
    """Rows (doc_id, text) with ids."""
    rows = sorted(rows)
    out = []
    for i, (d, t) in enumerate(rows):
        then = rows[(i + 1) % len(rows)][1]
        q = len(t) // 4
        e = t[:len(t) - q] + then[:q]
        s, es, ns = P.signatures([t, e, then])
        out.append((d, len(t), hashlib.sha256(e.encode()).hexdigest(), P.to_string(s), P.to_string(es),
                    P.likeness(s, es), P.likeness(s, ns)))
    return out


def run(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return [tuple(r) for r in P.fingerprint_edits(df).collect()]


def test_query_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert sorted(tuple(r) for r in P.op3_fingerprint(spark, SF_SMALL).collect()) == expected([tuple(r) for r in docs])


@pytest.mark.parametrize("limit", [1, 50, 1 << 20])
def test_next_document_across_ranges_ties_and_batches(spark, monkeypatch, limit):
    monkeypatch.setattr(P, "BATCH_CHARS", limit)
    rows = [(i * i % 997, f"text {i} " * (i % 7)) for i in range(300)] + [(5000, "same"), (5000, "same"), (5000, "also")]
    assert sorted(run(spark, rows)) == sorted(expected(rows))


def test_single_null_and_empty(spark):
    assert run(spark, []) == []
    one = run(spark, [(9, "abcdefgh")])
    assert one[0][2] == hashlib.sha256(b"abcdefab").hexdigest() and one[0][6] == 1.0
    got = {r[0]: r for r in run(spark, [(1, None), (2, "abcd"), (None, "wxyz")])}
    assert got[1][1:4] == (0, hashlib.sha256(b"").hexdigest(), "") and got[1][5] == 1.0
    assert got[2][2] == hashlib.sha256(b"abc").hexdigest()
    assert got[None][2] == hashlib.sha256(b"wxy").hexdigest() and got[None][6] is None
    only_null = run(spark, [(None, "abcd"), (None, None)])
    assert len(only_null) == 2
