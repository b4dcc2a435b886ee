"""Sinks: parquet tables, labelled console output, per-branch folders and
the one-upstream / many-outputs fan-out, for batch and for streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.streaming.versions import commit, uncommit

Outputs = dict[str, DataFrame]


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None,
                compression: str = "snappy") -> None:
    w = df.write.mode(mode).option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def labelled(df: DataFrame, label: str) -> DataFrame:
    """A print with a label: rows carry the label as their first column."""
    return df.select(F.lit(label).alias("label"), *df.columns)


def console_stream(df: DataFrame, label: str, mode: str = "append"):
    """Labelled console sink for a stream (development only: it prints on
    the driver)."""
    return labelled(df, label).writeStream.format("console").option("truncate", "false").outputMode(mode)


def write_branches(df: DataFrame, path: str, branch: str = "branch", mode: str = "overwrite") -> None:
    """One output folder per branch value (``branch=<value>``)."""
    write_table(df, path, mode=mode, partition_by=[branch])


def write_outputs(upstream: DataFrame, outputs: Callable[[DataFrame], Outputs], base: str,
                  mode: str = "overwrite") -> dict[str, str]:
    """Batch fan-out: compute ``upstream`` once (persisted for the writes),
    derive the named outputs from it and write each to ``base/<name>``."""
    up = upstream.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        paths = {}
        for name, df in outputs(up).items():
            paths[name] = f"{base.rstrip('/')}/{name}"
            write_table(df, paths[name], mode=mode)
        return paths
    finally:
        up.unpersist()


def fan_out_writer(outputs: Callable[[DataFrame], Outputs], base: str):
    """``foreachBatch`` function for a stream with several outputs: the
    micro-batch is computed once (persisted if it has more than one output), each output is written to
    ``base/<name>/batch=<id>``, and a marker last.  A replayed batch overwrites
    its own folders, and ``versions.read_committed`` reads whole batches only,
    so each output is exactly-once."""
    base = base.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        made = outputs(batch)
        if len(made) > 1:
            batch.persist(StorageLevel.MEMORY_AND_DISK)
        uncommit(batch.sparkSession, base, batch_id)
        try:
            for name, df in made.items():
                (df.withColumn("batch_id", F.lit(batch_id).cast("long"))
                   .write.mode("overwrite").parquet(f"{base}/{name}/batch={batch_id}"))
        finally:
            if len(made) > 1:
                batch.unpersist()
        commit(batch.sparkSession, base, batch_id)
    return write


def start_fan_out(stream: DataFrame, outputs: Callable[[DataFrame], Outputs], base: str, checkpoint: str,
                  every: str = "10 seconds", name: str | None = None):
    """Start a long-running stream that writes its outputs every ``every``
    (the commit cadence); returns the running query."""
    w = (stream.writeStream.foreachBatch(fan_out_writer(outputs, base))
         .option("checkpointLocation", checkpoint).trigger(processingTime=every))
    if name:
        w = w.queryName(name)
    return w.start()
