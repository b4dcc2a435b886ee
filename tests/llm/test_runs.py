import hashlib
import random
from zlib import crc32

from pyspark.sql import functions as F

from conftest import SF_SMALL
from rivulet.llm import runs as R

SCHEMA = "doc_id long, text string, runs string, collapsed string"


def brute(words):
    """All maximal stretches of every period, the least period of each."""
    out = {}
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(24, 3 * q):
                out.setdefault((i, j + q), q)
            i = j + 1
    return sorted((b, e - b, q) for (b, e), q in out.items())


def expected(doc_id, text):
    words = (text or "").encode().split()
    h = None if doc_id is None else crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
    return (doc_id, len(runs), *best, None if not runs else 1000 * best[1] // best[2],
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest())


def periodic(rng):
    k = rng.choice([1, 2, 3, 6, 60])
    words = [str(rng.randrange(k)) for _ in range(rng.randrange(0, 50))]
    for _ in range(rng.randrange(0, 4)):
        base = [str(rng.randrange(k + 1)) for _ in range(rng.randrange(1, 30))]
        n = rng.randrange(len(base), 6 * len(base) + 30)
        words += (base * (n // len(base) + 1))[:n]
        words += words[-rng.randrange(1, 30):] if rng.random() < 0.3 else []
    return words


def test_runs_are_those_of_all_periods_tried():
    rng = random.Random(12)
    documents = [periodic(rng) for _ in range(400)]
    assert R.find_runs(documents) == [brute(d) for d in documents]
    assert R.find_runs(documents[:1]) == [brute(documents[0])]


def test_words_repeated_at_every_scale():
    a, b = ["a", "b"], ["a"]
    while len(a) < 3000:
        a, b = a + b, a
    thue = [str(bin(i).count("1") % 2) for i in range(2048)]
    for words in (a, thue, ["x"] * 5000, ["x", "y"] * 1200 + ["x"] * 100, (["x"] * 30 + ["y"]) * 40):
        assert R.find_runs([words]) == [brute(words)]


def test_the_grammar_spells_the_text_and_pairs_are_used_up():
    import numpy as np

    rng = random.Random(3)
    seq = np.array([rng.randrange(3) for _ in range(500)])
    rules, left = R.re_pair(seq, 3)
    assert sum(n for _, n in left) == 500 and [p for p, _ in left] == list(np.cumsum([0, *(n for _, n in left)])[:-1])
    for half, size, places in rules:
        assert 0 < half < size and len(places) > 1
        assert len({tuple(seq[p:p + size]) for p in places}) == 1
        assert all(y - x >= size for x, y in zip(places, places[1:], strict=False))


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r) for r in R.op12_runs(spark, SF_SMALL).collect()}
    assert len(got) == len(docs) and sum(r[1] for r in got.values()) > 5
    for d in docs:
        assert got[d.doc_id] == expected(d.doc_id, d.text)


def test_awkward_rows(spark):
    rng = random.Random(5)
    long = " ".join(rng.choice("abc") for _ in range(4000)) + " q" * 30
    rows = [(None, None), (None, "k " * 40), (1, ""), (1, " \n\t"), (2, "z " * 30), (3, "x y " * 20), (3, "x y " * 20),
            (4, long), (10, "a" * 5000), *[(i, " ".join(periodic(rng))) for i in range(100, 160)]]
    df = spark.createDataFrame([(i, t, "mine", "mine") for i, t in rows], SCHEMA)
    found = R.with_runs(df, damage=True)
    assert found.columns == ["doc_id", "runs", "collapsed"]
    got = sorted((r.doc_id or -1, [tuple(x) for x in r.runs], bytes(r.collapsed)) for r in found.collect())
    want = []
    for i, t in rows:
        words = R.repeat_tail((t or "").encode().split(), i)
        runs = brute(words)
        gone = {j for s, n, q in runs for j in range(s + q, s + n)}
        want.append((i or -1, runs, b" ".join(w for j, w in enumerate(words) if j not in gone)))
    assert got == sorted(want)
    assert R.with_runs(df.where("false")).count() == 0


def test_strongest_compares_exactly(spark):
    big = 10 ** 8
    df = spark.createDataFrame([([(0, 3 * big, big), (5, 3 * big + 1, big), (9, 6 * big + 2, 2 * big)],), ([],)], f"runs {R.RUNS}")
    got = [r.best and tuple(r.best) for r in df.select(R.strongest(F.col("runs")).alias("best")).collect()]
    assert got == [(5, 3 * big + 1, big), None]
