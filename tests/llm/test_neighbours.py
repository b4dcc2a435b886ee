import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_CHECK
from rivulet.llm import neighbours as N


def brute(ids, vectors, asks, k):
    v, out = np.array(vectors, float), {}
    for i, q in enumerate(ids):
        if asks(q):
            s = (v * v[i]).sum(axis=1)
            order = [j for j in np.lexsort((ids, -s)) if ids[j] != q][:k]
            out[q] = [(ids[j], s[j]) for j in order]
    return out


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_recall_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF_CHECK}/embeddings.parquet").orderBy("vec_id").collect()
    want = brute([r.vec_id for r in rows], [r.embedding for r in rows], lambda q: q % 20 == 0, 20)
    got = answers(N.op5_neighbours(spark, SF_CHECK))
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    hits = sum(len({x for x, _ in got[q]} & {x for x, _ in want[q]}) for q in want)
    assert hits >= 0.93 * 20 * len(want)
    exact = {(q, x): s for q in want for x, s in want[q]}
    assert all(abs(exact[q, x] - s) < 1e-12 for q in got for x, s in got[q] if (q, x) in exact)


def test_all_axes_give_the_exact_answer_with_ties_and_crowds(spark):
    rng = np.random.RandomState(1)
    rows = [(i, rng.normal(size=5).tolist()) for i in range(120)]
    rows += [(1000 + i, rows[0][1]) for i in range(150)] + [(2000 + i, rows[3][1]) for i in range(4)]
    rows += [(3000, [9.0, 0.0, 0.0, 0.0, 0.0]), (3001, [0.0, 30.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = answers(N.nearest(df, F.col("vec_id") % 20 == 0, k=7, tables=2, probes=1 << 10, block=16))
    want = brute([r[0] for r in rows], [r[1] for r in rows], lambda q: q % 20 == 0, 7)
    assert got.keys() == want.keys()
    for q in want:
        assert [x for x, _ in got[q]] == [x for x, _ in want[q]]
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in want[q]], abs=1e-12)


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (1, [0.5, 0.5], 1), (2, None, 1), (3, [], 1), (4, [0.0, 0.0], 1), (5, [None, 1.0], 1),
            (6, [nan, 1.0], 1), (7, [inf, 1.0], 1), (None, [1.0, 1.0], 1), (20, [0.0, 0.0], 1), (40, [2.0], 1),
            (0, [1.0, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int")
    got = answers(N.nearest(df, F.col("vec_id") % 20 == 0))
    assert got == {0: [(40, 2.0), (1, 0.5)], 40: [(0, 2.0), (1, 1.0)]}
    assert N.nearest(df.limit(0), F.lit(True)).collect() == []
    assert N.nearest(df.where("vec_id = 1"), F.lit(True)).collect() == []
    assert N.nearest(df, F.lit(None).cast("boolean")).collect() == []


def unit(x):
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def shapes():
    rng = np.random.RandomState(5)
    even = unit(rng.normal(size=(2000, 64)))
    yield "uneven lengths", even * rng.lognormal(0, 0.5, (2000, 1)), 40
    yield "one long vector", np.concatenate([even, even[:1] * 10]), 40
    yield "128 dimensions", unit(rng.normal(size=(1500, 128))), 50
    yield "384 dimensions", unit(rng.normal(size=(800, 384))), 40
    yield "21 vectors", even[:21], 1
    yield "clusters", unit(np.repeat(even[:40], 50, axis=0) + 0.05 * rng.normal(size=(2000, 64))), 40


@pytest.mark.parametrize("vectors,each", [s[1:] for s in shapes()], ids=[s[0] for s in shapes()])
def test_recall_on_other_shapes(spark, vectors, each):
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    got = answers(N.nearest(df, F.col("vec_id") % each == 0))
    want = brute(list(range(len(vectors))), vectors, lambda q: q % each == 0, 20)
    assert got.keys() == want.keys() and all(len(got[q]) == 20 for q in want)
    hits = sum(len({x for x, _ in got[q]} & {x for x, _ in want[q]}) for q in want)
    assert hits >= 0.93 * 20 * len(want)


def test_pseudo_rotation_keeps_products():
    x = np.random.RandomState(0).normal(size=(20, 16))
    for y in N.rotated(x, 3):
        assert np.allclose(y @ y.T, x @ x.T)
        assert not np.allclose(y, x)
