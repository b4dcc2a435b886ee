"""Edge rows in small literal frames (FIXTURES.md section 4)."""

import datetime as dt
import math

from pyspark.sql import functions as F

from rivulet.functions.purchase import java_int, mask_card, reward_customer, to_dollars
from rivulet.functions.timecols import time_source, trade_event_time
from rivulet.operators.joins import interval_join, pair_purchases
from rivulet.operators.records import branch_by_department, json_decode
from rivulet.operators.running import repair_event_time, running_aggregate
from rivulet.operators.sessions import sessionize
from rivulet.operators.tables import latest_per_key
from rivulet.operators.topk import render_ranked, top_k_by_volume
from rivulet.schemas import PROPS

T0 = dt.datetime(2024, 1, 1)


def test_mask_card(spark):
    cases = {"1111-2222-3333-4444": "xxxx-xxxx-xxxx-4444", "1-2-3-4-5": "xxxx-xxxx-xxxx-4",
             "1-2-3-": "xxxx", "-2-3-4": "xxxx-xxxx-xxxx-4", "1234": "xxxx", "": "xxxx", None: None}
    df = spark.createDataFrame([(k,) for k in cases], "c string")
    got = {r.c: r.m for r in df.select("c", mask_card("c").alias("m")).collect()}
    assert got == cases


def test_reward_points_follow_jvm_narrowing(spark):
    df = spark.createDataFrame([(-3.9,), (1e12,), (-1e12,), (float("nan"),), (None,), (7.99,)], "t double")
    got = [r.p for r in df.select(java_int("t").alias("p")).collect()]
    assert got == [-3, 2147483647, -2147483648, 0, None, 7]


def test_reward_customer_renders_null_names(spark):
    df = spark.createDataFrame([(None, None), ("Smith", "Ann")], "last_name string, first_name string")
    assert [r.c for r in df.select(reward_customer().alias("c")).collect()] == ["null,null", "Smith,Ann"]


def test_to_dollars(spark):
    df = spark.createDataFrame([(109.0, "EURO"), (12.929, "POUNDS"), (5.0, "DOLLARS"), (1.0, "YEN")],
                               "a double, c string")
    got = [r.d for r in df.select(to_dollars("a", "c").alias("d")).collect()]
    assert math.isclose(got[0], 100.0) and math.isclose(got[1], 10.0) and got[2] == 5.0 and got[3] is None


def test_sessions_gap_inclusive(spark):
    rows = [("a", T0), ("a", T0 + dt.timedelta(seconds=20)),
            ("a", T0 + dt.timedelta(seconds=40, microseconds=1000)), ("b", T0)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz")
    got = sorted((r.k, r.session_start, r.session_end, r.n) for r in sessionize(df, ["k"], "ts", 20).collect())
    assert got == [("a", T0, T0 + dt.timedelta(seconds=20), 2),
                   ("a", T0 + dt.timedelta(seconds=40, microseconds=1000),
                    T0 + dt.timedelta(seconds=40, microseconds=1000), 1),
                   ("b", T0, T0, 1)]


def test_sessions_merge_across_time_buckets(spark):
    # Records every 15 s for 10 minutes: one session although it spans many
    # 60-second buckets; a 31-second pause then starts a new one.
    ts = [T0 + dt.timedelta(seconds=15 * i) for i in range(41)] + [T0 + dt.timedelta(seconds=631)]
    df = spark.createDataFrame([("k", t) for t in ts], "k string, ts timestamp_ntz")
    got = sorted((r.session_start, r.n) for r in sessionize(df, ["k"], "ts", 30, bucket_seconds=60).collect())
    assert got == [(T0, 41), (T0 + dt.timedelta(seconds=631), 1)]


def test_latest_per_key_deletes(spark):
    rows = [("a", 1.0, 1), ("a", None, 2),       # value then delete
            ("b", None, 1), ("b", 2.0, 2),       # delete then value
            ("c", None, 1),                      # only a delete
            ("d", 1.0, 5), ("d", 3.0, 6)]        # later sequence wins
    df = spark.createDataFrame(rows, "k string, v double, seq long")
    live = {r.k: r.v for r in latest_per_key(df, "k", "seq", ["v"]).collect()}
    assert live == {"b": 2.0, "d": 3.0}
    all_ = {r.k: r.v for r in latest_per_key(df, "k", "seq", ["v"], keep_deletes=True).collect()}
    assert all_ == {"a": None, "b": 2.0, "c": None, "d": 3.0}


def test_topk_ties_and_short_groups(spark):
    rows = [("X", "S1", 10), ("X", "S2", 10), ("X", "S0", 10), ("X", "S3", 5), ("X", "S4", 5),
            ("X", "S5", 1), ("Y", "T1", 1234567)]
    df = spark.createDataFrame(rows, "industry string, symbol string, shares long")
    top = top_k_by_volume(df)
    got = {r.industry: r.ranking for r in render_ranked(top).collect()}
    assert got["X"] == "1)S0:10 2)S1:10 3)S2:10 4)S3:5 5)S4:5 "
    assert got["Y"] == "1)T1:1,234,567 "


def test_pair_joiner_null_sides(spark):
    left = spark.createDataFrame(
        [(1, "u1", T0, 2.0, "a"), (2, "u2", T0, None, None), (3, "u3", T0, 1.0, "c")],
        "l_id long, l_user string, l_ts timestamp_ntz, l_value double, l_item string")
    right = spark.createDataFrame(
        [(10, "u1", T0 + dt.timedelta(hours=1), 3.0, "b"), (11, "u2", T0 + dt.timedelta(hours=2), 4.0, "d"),
         (12, "u9", T0, 5.0, "e"), (13, "u3", T0 + dt.timedelta(hours=7), 6.0, "f")],
        "r_id long, r_user string, r_ts timestamp_ntz, r_value double, r_item string")
    j = interval_join(left, right, ("l_user", "r_user"), ("l_ts", "r_ts"), 0, 6 * 3600, "full", "r_id")
    out = pair_purchases(j, {"customer": "l_user", "item": "l_item", "price": "l_value", "ts": "l_ts"},
                         {"customer": "r_user", "item": "r_item", "price": "r_value", "ts": "r_ts"})
    got = sorted((r.customer_id, tuple(r.items_purchased), r.total_amount) for r in out.collect())
    assert got == [("u1", ("a", "b"), 5.0), ("u2", ("d",), 4.0), ("u3", ("c",), 1.0),
                   ("u3", ("f",), 6.0), ("u9", ("e",), 5.0)]


def test_interval_join_boundaries(spark):
    left = spark.createDataFrame([(1, "u", T0)], "l_id long, l_user string, l_ts timestamp_ntz")
    offs = [-1, 0, 6 * 3600, 6 * 3600 + 1]
    right = spark.createDataFrame([(i, "u", T0 + dt.timedelta(seconds=s)) for i, s in enumerate(offs)],
                                  "r_id long, r_user string, r_ts timestamp_ntz")
    got = sorted(r.r_id for r in interval_join(left, right, ("l_user", "r_user"), ("l_ts", "r_ts"),
                                               0, 6 * 3600).collect())
    assert got == [1, 2]


def test_event_time_sources(spark):
    df = spark.createDataFrame([(True, T0, T0 + dt.timedelta(1)), (True, None, T0 + dt.timedelta(1)),
                                (False, T0, T0)], "t boolean, tx timestamp_ntz, rec timestamp_ntz")
    wall = F.lit(dt.datetime(2030, 1, 1)).cast("timestamp_ntz")
    got = [(r.s, r.e) for r in df.select(time_source(F.col("t"), F.col("tx")).alias("s"),
                                         trade_event_time(F.col("t"), F.col("tx"), F.col("rec"), wall).alias("e"))
           .collect()]
    assert got == [("trade", T0), ("record", T0 + dt.timedelta(1)), ("wall_clock", dt.datetime(2030, 1, 1))]


def test_event_time_repair(spark):
    rows = [(0, 0, -1), (0, 1, 100), (0, 2, -5), (0, 3, 50), (0, 4, -1), (1, 0, 7), (1, 1, -1)]
    df = spark.createDataFrame(rows, "partition int, offset long, ts_ms long")
    got = {(r.partition, r.offset): r.event_ms for r in repair_event_time(df, bucket_rows=2).collect()}
    assert got == {(0, 0): None, (0, 1): 100, (0, 2): 100, (0, 3): 50, (0, 4): 100, (1, 0): 7, (1, 1): 7}


def test_running_sum_across_buckets(spark):
    df = spark.range(0, 100).select(F.lit("k").alias("k"), F.col("id"), F.col("id").alias("v"))
    out = running_aggregate(df, ["k"], F.floor(F.col("id") / 7), [F.col("id")], F.col("v"), "rs")
    assert all(r.rs == r.id * (r.id + 1) // 2 for r in out.collect())


def test_branch_department(spark):
    df = spark.createDataFrame([("COFFEE",), ("Coffee",), ("electronics",), ("toys",), (None,)], "department string")
    got = sorted(r.branch for r in branch_by_department(df).collect())
    assert got == ["coffee", "coffee", "electronics"]


def test_json_decode_flags_malformed(spark):
    df = spark.createDataFrame([(1, '{"k": 3}'), (2, "not json"), (3, None)], "id long, value string")
    got = {r.id: (r.k, r._malformed) for r in json_decode(df, PROPS).collect()}
    assert got == {1: (3, False), 2: (None, True), 3: (None, False)}


def test_name_parts_match_split_part(spark):
    from rivulet.sources.fixtures import name_part

    df = spark.createDataFrame([(x,) for x in ["Customer#0001", "a#b#c", "plain", "#x", "y#", "", None]],
                               "c_name string")
    rows = df.select(name_part("c_name", 1).alias("a"), F.split_part("c_name", F.lit("#"), F.lit(1)).alias("a2"),
                     name_part("c_name", 2).alias("b"), F.split_part("c_name", F.lit("#"), F.lit(2)).alias("b2")
                     ).collect()
    assert all(r.a == r.a2 and r.b == r.b2 for r in rows)


def test_progress_percent_rounds_half_to_even(spark):
    from rivulet.operators.monitoring import progress_percent

    rows = [(0, 0)] + [(0, 1)] * 2 + [(0, 2)] * 797
    df = spark.createDataFrame(rows, "p int, b int")
    got = [r.percent_complete for r in progress_percent(df, F.col("p"), F.col("b")).orderBy("batch").collect()]
    assert got == [0.12, 0.38, 100.0]  # 1 of 800 is 0.125 %, 3 of 800 is 0.375 %


def test_running_sum_of_a_null_key(spark):
    df = spark.createDataFrame([(None, i, 1) for i in range(6)], "k string, id long, v long")
    out = running_aggregate(df, ["k"], F.floor(F.col("id") / 2), [F.col("id")], F.col("v"), "rs")
    assert [r.rs for r in out.orderBy("id").collect()] == [1, 2, 3, 4, 5, 6]


def test_dimension_with_two_rows_for_a_key(spark):
    from rivulet.operators.joins import join_dimension

    facts = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    dim = spark.createDataFrame([("a", "old", 1), ("a", "new", 2), ("c", "x", 1)], "k string, name string, at int")
    got = sorted((r.v, r.name) for r in join_dimension(facts, dim, "k", order="at").collect())
    assert got == [(1, "new"), (2, None), (3, None)]
    assert join_dimension(facts, dim.select("k"), "k", how="inner").count() == 1


def test_records_without_key_are_spread(spark):
    from rivulet.operators.records import partition_by_key

    df = spark.range(1000).select(F.lit(None).cast("string").alias("k"), "id")
    used = partition_by_key(df, "k", 16, F.col("id")).select(F.spark_partition_id().alias("p")).distinct().count()
    assert used == 16


def test_keys_beyond_the_items_keep_a_row(spark):
    from rivulet.operators.aggregates import pair_by_rank, reduce_share_volume

    keys = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    items = spark.createDataFrame([(1, "one")], "id long, text string")
    got = sorted((r.k, r.text) for r in pair_by_rank(keys, "k", items, "id", ["id", "text"]).collect())
    assert got == [("a", "one"), ("b", None), ("c", None)]
    trades = spark.createDataFrame([("S", "x", 2, 1), ("S", "y", 3, 2)], "symbol string, industry string, shares int, ts int")
    assert [tuple(r) for r in reduce_share_volume(trades).collect()] == [("S", "y", 5)]
