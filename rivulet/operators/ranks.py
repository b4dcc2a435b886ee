"""Row numbers over a whole table, without bringing it to one task."""

from __future__ import annotations

from math import isqrt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rivulet.session import scratch_dir

#: ``monotonically_increasing_id`` holds the partition above these bits, the row's place in it below
PLACE_BITS = 33


def numbered(df: DataFrame, order: list[str], out: str = "_n") -> DataFrame:
    """``df`` with each row's number (long, from 1) in ascending order of ``order`` (nulls first), which should tell rows
    apart: rows with equal values are in one partition and get different numbers in no stated order.

    Rows are dealt over the shuffle partitions by ranges of ``order``, sorted there, and written with their place to the
    shared folder, so that counting and numbering see the same partitions. A partition's first number is the count of the
    rows before it: prefix sums within blocks of partitions, and of the blocks; no step brings all rows, or all
    partitions' counts, to one task."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = (df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
              .withColumn("_place", F.monotonically_increasing_id()))
    path = scratch_dir(spark, "numbered") + "/rows"
    placed.write.parquet(path)
    rows = spark.read.schema(placed.schema).parquet(path).withColumn("_part", F.shiftright("_place", PLACE_BITS))
    width = max(1, isqrt(parts))
    counts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_count")).withColumn("_block", F.floor(F.col("_part") / width))
    last = (parts - 1) // width
    totals = counts.groupBy("_block").agg(F.sum("_count").alias("_total")).where(F.col("_block") < last)
    earlier = (totals.select(F.explode(F.sequence(F.col("_block") + 1, F.lit(last).cast("long"))).alias("_block"), "_total")
               .groupBy("_block").agg(F.sum("_total").alias("_blocks")))
    before = Window.partitionBy("_block").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (counts.withColumn("_before", F.sum("_count").over(before)).join(earlier, "_block", "left")
              .select("_part", (F.coalesce("_before", F.lit(0)) + F.coalesce("_blocks", F.lit(0))).alias("_start")))
    place = F.col("_place").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return rows.join(starts, "_part").withColumn(out, F.col("_start") + place + 1).drop("_part", "_place", "_start")
