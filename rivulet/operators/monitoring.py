"""Progress and observation operators (monitoring re-aimed as data work)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def progress_percent(df: DataFrame, partition: Column, batch: Column) -> DataFrame:
    """Per partition and batch: records completed in the batch, running total
    so far, partition total, and percent complete rounded half-even to two
    places (integer arithmetic on the exact ratio).  Records are first
    reduced per (partition, batch) map-side; the windows then see one row per
    batch."""
    per = (df.groupBy(partition.alias("partition"), batch.alias("batch"))
             .agg(F.count(F.lit(1)).alias("batch_completed")))
    w = Window.partitionBy("partition").orderBy("batch")
    per = (per.withColumn("restored_so_far", F.sum("batch_completed")
                          .over(w.rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("total_to_restore", F.sum("batch_completed")
                          .over(Window.partitionBy("partition"))))
    whole = F.expr("(restored_so_far * 10000) div total_to_restore")
    twice = F.expr("2 * ((restored_so_far * 10000) % total_to_restore)")
    up = (twice > F.col("total_to_restore")) | ((twice == F.col("total_to_restore")) & (whole % 2 == 1))
    bp = whole + up.cast("long")
    return per.withColumn("percent_complete", bp.cast("double") / F.lit(100.0))


def observed(df: DataFrame, name: str, *metrics: Column) -> DataFrame:
    """Pass-through with named metrics (a peek that logs nothing per row)."""
    ms = metrics or (F.count(F.lit(1)).alias("rows"),)
    return df.observe(name, *ms)


def describe(df: DataFrame, mode: str = "formatted") -> str:
    """The dataflow of a query as text (its physical plan)."""
    import io
    from contextlib import redirect_stdout

    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()
