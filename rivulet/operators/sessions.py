"""Session windows (inactivity gap) per key, exact and split for hot keys.

A record joins the previous record's session when it is at most ``gap``
later (inclusive).  Each session is reported with its first and last record
time and its record count.

Plan: rows of one key whose times fall into one slot of the gap's length are
always in one session, so rows are first reduced to one per (key, slot), in
every map task before the shuffle: a hot key's raw rows never meet.  Slots
are then cut into buckets; sessions are built inside each (key, bucket).  A
local session that is neither the first nor the last of its bucket is
already final.  Only first and last local sessions, at most two per (key,
bucket), can continue across a bucket border; they are merged per key with a
gaps-and-islands pass over that small set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.functions.timecols import epoch_micros


def _new_session(start_us: str, prev_end_us: Column, gap_us: int) -> Column:
    return F.when(prev_end_us.isNull() | ((F.col(start_us) - prev_end_us) > F.lit(gap_us)), 1).otherwise(0)


def sessionize(df: DataFrame, keys: list[str], ts: str, gap_seconds: int,
               bucket_seconds: int | None = None) -> DataFrame:
    gap_us = max(int(gap_seconds * 1_000_000), 1)
    bucket_us = int((bucket_seconds or max(64 * gap_seconds, 3600)) * 1_000_000)
    us = epoch_micros("_ts")
    # 1. one row per (key, slot)
    slots = (df.where(F.col(ts).isNotNull()).select(*keys, F.col(ts).alias("_ts"))
               .withColumns({"_us": us, "_slot": F.floor(us / F.lit(gap_us))})
               .groupBy(*keys, "_slot")
               .agg(F.min("_ts").alias("_first"), F.max("_ts").alias("_final"), F.min("_us").alias("_us"),
                    F.max("_us").alias("_until"), F.count(F.lit(1)).alias("_n")))
    d = slots.withColumn("_b", F.floor(F.col("_us") / F.lit(bucket_us)))
    # 2. local sessions inside each (key, bucket)
    w = Window.partitionBy(*keys, "_b").orderBy("_us")
    d = d.withColumn("_new", _new_session("_us", F.lag("_until").over(w), gap_us))
    d = d.withColumn("_sid", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    local = (d.groupBy(*keys, "_b", "_sid")
              .agg(F.min("_first").alias("session_start"), F.max("_final").alias("session_end"),
                   F.min("_us").alias("_s"), F.max("_until").alias("_e"),
                   F.sum("_n").alias("n")))
    local = local.withColumn("_last", F.max("_sid").over(Window.partitionBy(*keys, "_b")))
    # 3. first/last local sessions of every bucket of a key share one window
    #    partition (_grp = -1) and are merged there; an interior session is
    #    alone in its own partition (_grp = bucket, _gsid = its id).
    is_edge = (F.col("_sid") == 1) | (F.col("_sid") == F.col("_last"))
    local = (local.withColumn("_grp", F.when(is_edge, F.lit(-1)).otherwise(F.col("_b")))
                  .withColumn("_gsid", F.when(is_edge, F.lit(0)).otherwise(F.col("_sid"))))
    we = Window.partitionBy(*keys, "_grp", "_gsid").orderBy("_s")
    local = local.withColumn("_new", _new_session("_s", F.lag("_e").over(we), gap_us))
    local = local.withColumn("_gid", F.sum("_new").over(we.rowsBetween(Window.unboundedPreceding, 0)))
    return (local.groupBy(*keys, "_grp", "_gsid", "_gid")
                 .agg(F.min("session_start").alias("session_start"),
                      F.max("session_end").alias("session_end"),
                      F.sum("n").alias("n"))
                 .select(*keys, "session_start", "session_end", "n"))
