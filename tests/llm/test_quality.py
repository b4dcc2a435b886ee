import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_CHECK
from rivulet.llm import quality as Q


def area(scores, labels):
    """Probability that a good text scores above a bad one."""
    good, bad = scores[labels == 1], scores[labels == 0]
    return np.mean([(good > b).mean() + (good == b).mean() / 2 for b in bad])


def test_held_out_accuracy_and_contract(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = Q.op2_quality(spark, folder).cache()
    assert rows.count() == docs.count()
    for r in rows.collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    known = rows.where("held_out").join(labels, "doc_id").select("score", "quality", "predicted").collect()
    y = np.array([r.quality for r in known])
    assert area(np.array([r.score for r in known]), y) > 0.98
    assert np.mean([r.predicted == 1 for r in known if r.quality == 1]) > 0.97


def test_held_out_labels_and_other_columns_do_not_matter(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    labels = spark.read.parquet(f"{SF_CHECK}/labels.parquet")
    other = labels.withColumn("quality", F.when(Q.held_out(F.col("doc_id")), 1 - F.col("quality"))
                              .otherwise(F.col("quality")))
    changed = docs.withColumns({"lang": F.lit("xx"), "source": F.lit(None)})
    a, b = Q.learn(docs, labels), Q.learn(changed, other)
    assert (a.good, a.bad, a.weights) == (b.good, b.bad, b.weights)


def test_scores_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "text")
    model = Q.learn(docs, spark.read.parquet(f"{SF_CHECK}/labels.parquet"))
    sizer = Q.Sizer(model)
    for r in Q.score_quality(docs.limit(60), model).collect():
        want = float(Q.sigmoid(np.array(np.dot(sizer.features(r.text), model.weights))))
        assert r.score == pytest.approx(want, abs=1e-12)


def test_nulls_empty_long_repeats_and_clashing_names(spark):
    rng = np.random.RandomState(0)
    good = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta", "of", "the"], 40)) for _ in range(60)]
    bad = ["$$$ %%% " * int(rng.randint(5, 30)) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(good + bad)] + [(500, None), (501, ""), (502, good[0]), (502, good[0]),
                                                         (None, good[1]), (503, "alpha of the " * 60_000)]
    docs = spark.createDataFrame([(*r, 7, "x") for r in rows], "doc_id long, text string, score int, good string")
    labels = spark.createDataFrame([(i, int(i < 60)) for i in range(120)] + [(500, None), (None, 1), (3, 1)],
                                   "doc_id long, quality int")
    model = Q.learn(docs, labels)
    got = Q.score_quality(docs.select("doc_id", "text"), model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r.score)
    assert by[500] == by[501] and by[502][0] == by[502][1] and len(by[503]) == 1
    assert area(np.array([by[i][0] for i in range(120)]), np.array([1] * 60 + [0] * 60)) > 0.99


def test_without_both_classes_every_score_is_half(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    for labels in ([], [(1, 1), (2, None)]):
        model = Q.learn(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
        assert model is None
        assert [(r.score, r.predicted) for r in Q.score_quality(docs, model).collect()] == [(0.5, 1)] * 2
    assert Q.score_quality(docs.limit(0), None).collect() == []
