"""Streams whose cost per key or per chunk once grew too fast: native state, one clock for two sides, even chunks."""

import datetime as dt
import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from rivulet.session import scratch_dir
from rivulet.sources.sinks import fan_out_writer
from rivulet.streaming import harness as H
from rivulet.streaming import operators as O
from rivulet.streaming.ranking import bucket_lists
from rivulet.streaming.versions import read_committed


def streaming(spark, schema):
    return spark.readStream.schema(schema).parquet(scratch_dir(spark, "scale-in"))


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue()


def is_native(df):
    return not any(word in plan(df) for word in ("Python", "PySpark", "Pandas", "MapInArrow"))


def test_reward_days_are_kept_without_python(spark):
    assert is_native(O.reward_days(streaming(spark, "customer_id string, day int, points long")))


def test_pairs_are_kept_without_python(spark):
    schema = "id long, who string, ts timestamp_ntz"
    assert is_native(O.retained_pairs(streaming(spark, schema), streaming(spark, schema), "who", "ts", "id"))


def test_rankings_are_kept_without_python(spark):
    s = streaming(spark, "industry string, symbol string, shares long, n long")
    assert is_native(bucket_lists(s, F.col("industry"), F.col("symbol"), F.col("shares"), F.col("n")))


def test_pairs_count_whole_milliseconds_and_follow_the_later_side(spark):
    schema = "id long, who string, ts timestamp_ntz"
    paths = [scratch_dir(spark, f"clock-{s}") for s in "ab"]
    out, ckpt = scratch_dir(spark, "clock-out"), scratch_dir(spark, "clock-ckpt")
    at = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)

    def run(a, b):
        for path, rows in zip(paths, (a, b), strict=True):
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        streams = [H.file_stream(spark, p, spark.createDataFrame([], schema).schema, max_files=1) for p in paths]
        df = O.retained_pairs(*streams, "who", "ts", "id")
        H.run_to_end(H.start_with_partitions(spark, df.writeStream.format("parquet").option("path", out)
                                             .option("checkpointLocation", ckpt).trigger(availableNow=True)))
        return sorted((r.key, r.a_id, r.b_id, r.b_ms - r.a_ms) for r in spark.read.schema(df.schema).parquet(out).collect())

    # 120 s and 99 microseconds apart, but 120,000 whole milliseconds; the next one is 120,001
    first = run([(1, "u", at(0.0009)), (2, "w", at(0.0009))], [(3, "u", at(120.000999)), (4, "w", at(120.001))])
    assert first == [("u", 1, 3, 120_000)]
    run([(5, "z", at(5000))], [(6, "y", at(121))])  # only side a goes on
    assert run([(7, "u", at(5001))], [(8, "u", at(122)), (9, "u", at(5002))]) == [*first, ("u", 7, 9, 1000)]


def test_a_chunk_is_spread_over_the_cores_and_a_batch_holds_one(spark, monkeypatch):
    monkeypatch.setattr(H, "LEAST_FILE_BYTES", 1 << 10)
    rows = [(i % 4, f"text {i} " * 5) for i in range(4000) if i % 4 != 1] + [(1, "one row only")]
    df = spark.createDataFrame(rows, "part int, text string").repartition(3)
    path = H.stage_chunks(spark, df, F.col("part"), "even", cuts=[0, 1, 2])
    assert path.files == min(spark.sparkContext.defaultParallelism, path.files) > 1
    assert H.data_files(spark, path) == 4 * path.files
    seen = {}
    H.run_batches(spark, H.file_stream(spark, path, df.schema), "even",
                  lambda b, i: seen.update({i: {r.part: r["count"] for r in b.groupBy("part").count().collect()}}))
    assert seen == {0: {0: 1000}, 1: {1: 1}, 2: {2: 1000}, 3: {3: 1000}}


@pytest.mark.parametrize("names, held", [("a", 0), ("ab", 1)])
def test_a_batch_is_held_only_for_several_outputs(spark, monkeypatch, names, held):
    calls = []
    persist = type(spark.range(1)).persist
    monkeypatch.setattr(type(spark.range(1)), "persist", lambda self, *a: calls.append(1) or persist(self, *a))
    base = scratch_dir(spark, "held")
    fan_out_writer(lambda batch: {n: batch.where(F.col("id") > 1) for n in names}, base)(spark.range(5), 0)
    assert len(calls) == held
    assert all(read_committed(spark, base, n).count() == 3 for n in names)
