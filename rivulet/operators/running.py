"""Running (prefix) aggregates that stay exact when one key is hot.

A plain ``sum() OVER (PARTITION BY key ORDER BY t ROWS UNBOUNDED PRECEDING)``
sends every row of a key to one task.  ``running_aggregate`` splits each key
into ordered buckets instead:

1. per (key, bucket) a local running value (window partitioned by key+bucket);
2. per (key, bucket) the bucket total, pre-aggregated map-side;
3. per key a prefix over the bucket totals of earlier buckets (one row per
   bucket, so small);
4. local value combined with the prefix of earlier buckets.

Steps 1 and 4 share one hash partitioning on (key, bucket).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_aggregate(df: DataFrame, keys: list[str], bucket: Column, order: list[Column],
                      value: Column, out: str, how: str = "sum") -> DataFrame:
    if how not in ("sum", "max"):
        raise ValueError("how must be 'sum' or 'max'")
    agg = F.sum if how == "sum" else F.max
    b = df.withColumn("_bucket", bucket).withColumn("_val", value)
    local_w = (Window.partitionBy(*keys, "_bucket").orderBy(*order)
                     .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = b.withColumn("_local", agg("_val").over(local_w))
    # Bucket totals: a second, narrow pass that is reduced in every map task before its shuffle.
    totals = b.groupBy(*keys, "_bucket").agg(agg("_val").alias("_btotal"))
    prior_w = (Window.partitionBy(*keys).orderBy("_bucket")
                     .rowsBetween(Window.unboundedPreceding, -1))
    names = {k: f"_of_{k}" for k in [*keys, "_bucket"]}
    prior = totals.select(*[F.col(k).alias(n) for k, n in names.items()], agg("_btotal").over(prior_w).alias("_prior"))
    # null-safe: a null key is a key like any other
    meet = F.lit(True)
    for k, n in names.items():
        meet = meet & F.col(k).eqNullSafe(F.col(n))
    joined = local.join(prior, meet, "left").drop(*names.values())
    if how == "sum":
        result = F.when(F.col("_local").isNull() & F.col("_prior").isNull(), F.lit(None)) \
                  .otherwise(F.coalesce("_local", F.lit(0)) + F.coalesce("_prior", F.lit(0)))
    else:
        result = F.greatest("_local", "_prior")
    return joined.withColumn(out, result).drop("_bucket", "_val", "_local", "_prior")


def repair_event_time(records: DataFrame, partition: str = "partition", offset: str = "offset",
                      ts_ms: str = "ts_ms", bucket_rows: int = 1 << 20) -> DataFrame:
    """Replace an invalid (negative) timestamp with the highest valid one seen
    earlier in the same partition (by offset).  Null if none was seen yet."""
    valid = F.when(F.col(ts_ms) >= 0, F.col(ts_ms))
    out = running_aggregate(records, [partition], F.floor(F.col(offset) / F.lit(bucket_rows)),
                            [F.col(offset)], valid, "_partition_time", how="max")
    return (out.withColumn("event_ms", F.when(F.col(ts_ms) >= 0, F.col(ts_ms))
                                        .otherwise(F.col("_partition_time")))
               .withColumn("repaired", F.col(ts_ms) < 0)
               .drop("_partition_time"))


def reward_running_totals(purchases: DataFrame) -> DataFrame:
    """Accumulated reward points per customer and days since the previous
    purchase day.  Purchases are first reduced per (customer, day) map-side,
    which bounds a customer's window to the number of distinct days."""
    from rivulet.functions.purchase import amount, java_int
    daily = (purchases.groupBy("customer_id", "purchase_date")
                      .agg(F.count(F.lit(1)).alias("n_purchases"),
                           F.sum(java_int(amount()).cast("long")).alias("day_points")))
    w = Window.partitionBy("customer_id").orderBy("purchase_date")
    return (daily.withColumn("total_reward_points",
                             F.sum("day_points").over(w.rowsBetween(Window.unboundedPreceding, 0)))
                 .withColumn("days_from_last_purchase",
                             F.coalesce(F.datediff(F.to_date("purchase_date"),
                                                   F.to_date(F.lag("purchase_date").over(w))),
                                        F.lit(0))))
