"""One key holding a third of the rows: the split operators stay exact.

The hot table is derived by Spark from the driver's events (every third
event is moved to user 0) and written to the scratch folder; DuckDB brute
force on the same file is the reference.
"""

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SF_CHECK
from oracle_compare import canon
from rivulet.operators.joins import interval_join
from rivulet.operators.running import running_aggregate
from rivulet.operators.sessions import sessionize
from rivulet.session import scratch_dir
from rivulet.sources.tables import read_table


@pytest.fixture(scope="module")
def hot(spark):
    ev = read_table(spark, SF_CHECK, "events", "event_id", "ts", "user_id", "event_type", "value")
    ev = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))
    path = scratch_dir(spark, "hot-events")
    ev.write.mode("overwrite").parquet(path)
    local = path[len("file:"):] if path.startswith("file:") else path
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    con.execute(f"create view hot as select * from read_parquet('{local}/*.parquet')")
    return spark.read.parquet(path), con


def _same(df, con, sql):
    a = canon(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(sql)
    b = canon(list(rel.columns), rel.fetchall())
    assert a == b


def test_hot_key_holds_a_third(hot):
    df, _ = hot
    share = df.where("user_id = 0").count() / df.count()
    assert share >= 1 / 3


def test_sessions_on_hot_key(hot):
    df, con = hot
    out = sessionize(df, ["user_id"], "ts", 3600, bucket_seconds=6 * 3600)
    _same(out, con, """with s as (select *, case when lag(ts) over w is null
        or ts - lag(ts) over w > interval 1 hour then 1 else 0 end ns from hot
        window w as (partition by user_id order by ts)),
      g as (select *, sum(ns) over (partition by user_id order by ts rows unbounded preceding) gid from s)
      select user_id, min(ts) session_start, max(ts) session_end, count(*) n from g group by user_id, gid""")


@pytest.mark.parametrize("how", ["inner", "left", "full"])
def test_interval_join_on_hot_key(hot, how):
    df, con = hot
    left = df.where("event_type = 'view'").select(F.col("event_id").alias("l_id"), F.col("user_id").alias("l_user"),
                                                  F.col("ts").alias("l_ts"))
    right = df.where("event_type = 'purchase'").select(F.col("event_id").alias("r_id"),
                                                       F.col("user_id").alias("r_user"), F.col("ts").alias("r_ts"))
    out = interval_join(left, right, ("l_user", "r_user"), ("l_ts", "r_ts"), 0, 6 * 3600, how, "r_id")
    _same(out.select("l_id", "r_id"), con, f"""select l_id, r_id from
        (select event_id l_id, user_id l_user, ts l_ts from hot where event_type = 'view') l {how} join
        (select event_id r_id, user_id r_user, ts r_ts from hot where event_type = 'purchase') r
        on l_user = r_user and r_ts >= l_ts and r_ts <= l_ts + interval 6 hour""")


def test_running_sum_on_hot_key(hot):
    df, con = hot
    out = running_aggregate(df, ["user_id"], F.floor(F.col("event_id") / 500), [F.col("event_id")],
                            F.round(F.col("value") * 100).cast("long"), "running")
    _same(out.select("event_id", "running"), con, """select event_id,
        sum(cast(round(value * 100) as bigint)) over (partition by user_id order by event_id
        rows between unbounded preceding and current row) as running from hot""")


def test_full_interval_join_by_union_on_hot_key(hot):
    from rivulet.operators.joins import interval_join_full_union

    df, con = hot
    left = df.where("event_type = 'view'").select(F.col("event_id").alias("l_id"), F.col("user_id").alias("l_user"),
                                                  F.col("ts").alias("l_ts"))
    right = df.where("event_type = 'purchase'").select(F.col("event_id").alias("r_id"),
                                                       F.col("user_id").alias("r_user"), F.col("ts").alias("r_ts"))
    out = interval_join_full_union(left, right, ("l_user", "r_user"), ("l_ts", "r_ts"), 0, 6 * 3600)
    _same(out.select("l_id", "r_id"), con, """select l_id, r_id from
        (select event_id l_id, user_id l_user, ts l_ts from hot where event_type = 'view') l full join
        (select event_id r_id, user_id r_user, ts r_ts from hot where event_type = 'purchase') r
        on l_user = r_user and r_ts >= l_ts and r_ts <= l_ts + interval 6 hour""")
