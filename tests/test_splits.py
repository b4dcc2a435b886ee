"""Work that is split within a hot key or a whole table: row numbers, co-group lists, stream sessions, reward days."""

import datetime as dt
import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from rivulet.operators.aggregates import pair_by_rank
from rivulet.operators.cogroup import cogroup
from rivulet.operators.ranks import numbered
from rivulet.plans import catalog as C
from rivulet.session import scratch_dir
from rivulet.streaming import operators as O
from rivulet.streaming.harness import (MERGE_SESSIONS, file_stream, read_batches, run_to_end, run_update, stage_chunks,
                                       start_with_partitions)


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue()


@pytest.mark.parametrize("rows", [0, 1, 7, 5000])
def test_numbers_equal_a_window_over_all_rows(spark, rows):
    df = spark.range(rows).select((F.col("id") * 7919 % 5003).alias("id"), F.col("id").cast("string").alias("text"))
    want = {r.id: r.n for r in df.select("id", F.row_number().over(Window.orderBy("id")).alias("n")).collect()}
    got = numbered(df, ["id"], "n")
    assert {r.id: r.n for r in got.collect()} == want and got.columns == ["id", "text", "n"]


def test_numbers_with_nulls_and_equal_values(spark):
    df = spark.createDataFrame([(None,), (3,), (3,), (1,), (None,)], "id long")
    got = sorted((r._n, r.id) for r in numbered(df, ["id"]).collect())
    assert got == [(1, None), (2, None), (3, 1), (4, 3), (5, 3)]


def test_ranks_are_paired_without_a_single_task(spark):
    p = plan(C.q_headline_per_industry(spark, SF_SMALL))
    assert "SinglePartition" not in p and "Exchange" in p
    keys = spark.range(300).select((F.col("id") * 3).alias("k"))
    items = spark.range(1000).select((F.col("id") * 2).alias("id"), F.concat(F.lit("t"), "id").alias("text"))
    got = sorted(tuple(r) for r in pair_by_rank(keys, "k", items, "id", ["id", "text"]).collect())
    assert got == [(3 * i, 2 * i, f"t{i}") for i in range(300)]


def test_cogroup_of_a_hot_day_is_numbered_by_time_slots(spark):
    day = dt.datetime(2024, 1, 1)
    rows = [(day + dt.timedelta(seconds=(i * 37) % 80000), 0 if i % 3 else None, i) for i in range(3000)]
    a = spark.createDataFrame(rows, "ts timestamp_ntz, user long, id long")
    b = a.where("id % 5 = 0")
    out = cogroup(a, b, "user", "ts", "id", chunk_size=70)
    w = Window.partitionBy("user").orderBy("ts", "id")
    for side, column in ((a, "ids_a"), (b, "ids_b")):
        want = {(r.id, r.user): r.chunk for r in side.withColumn(
            "chunk", F.floor((F.row_number().over(w) - 1) / 70)).collect()}
        got = {(i, r.key): r.chunk for r in out.collect() for i in r[column]}
        assert got == want


def test_sessions_are_merged_before_the_shuffle(spark):
    before = spark.conf.get(MERGE_SESSIONS)
    day = dt.datetime(2024, 1, 1)
    rows = [(1 if i % 3 else i, day + dt.timedelta(minutes=i)) for i in range(600)]
    df = spark.createDataFrame(rows, "user long, ts timestamp_ntz")
    path = stage_chunks(spark, df, F.col("ts").cast("string").cast("timestamp").cast("long"), "merged", n_chunks=2)
    s = O.session_counts(file_stream(spark, path, df.schema), ["user"], "10 minutes", "1 hour")
    q = start_with_partitions(spark, s.writeStream.format("noop").outputMode("append").trigger(availableNow=True)
                              .option("checkpointLocation", scratch_dir(spark, "merged-ckpt")))
    run_to_end(q)
    out = io.StringIO()
    with redirect_stdout(out):
        q.explain()
    p = out.getvalue()
    assert "MergingSessions" in p[p.index("Exchange"):]  # an operator below the exchange comes later in the text
    assert spark.conf.get(MERGE_SESSIONS) == before


def test_reward_days_late_days_null_keys_and_one_day(spark):
    chunks = [[("a", 100, 5), ("a", 100, 6), ("b", 7, 1), (None, 3, 2)], [("a", 90, 1), ("b", 7, None), (None, None, 4)],
              [("a", 95, 2), ("a", 100, 1), (None, 9, 1)], [("a", 130, 1)]]
    schema = "customer_id string, day int, points long"
    path = scratch_dir(spark, "reward-days")
    for rows in chunks:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    days = O.reward_days(file_stream(spark, path, spark.createDataFrame([], schema).schema, max_files=1))
    back = read_batches(spark, run_update(spark, days, "days"), days.schema).collect()
    of = lambda batch: {r.customer_id: tuple(r)[1:5] for r in back if r.batch_id == batch}
    assert of(0) == {"a": (11, 2, 100, 0), "b": (1, 1, 7, 0), None: (2, 1, 3, 0)}
    assert of(1) == {"a": (12, 3, 100, 10), "b": (1, 2, 7, 0), None: (6, 2, 3, 0)}
    assert of(2) == {"a": (15, 5, 100, 5), None: (7, 3, 9, 6)}
    assert of(3) == {"a": (16, 6, 130, 30)}
