"""Running a plan as a real stream over data Spark derives from the tables.

``stage_chunks`` writes a DataFrame as an ordered sequence of parquet chunks
(one append per range of an ordering column) under the shared scratch
folder; ``file_stream`` reads them back as a stream, one chunk per trigger,
so the query sees several micro-batches in arrival order.  Chunks and their
files are sized by bytes.  Sinks: the parquet file sink for append mode
(exactly-once through its commit log), and a ``foreachBatch`` writer that
overwrites ``batch=<n>`` for update mode (a replayed batch rewrites its own
folder; a reader that comes in between can see a folder half written).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, StructField, StructType

from rivulet.session import scratch_dir

FILE_BYTES = 128 << 20
#: a chunk of more bytes than this is spread over the cores, in files of at least so many bytes
LEAST_FILE_BYTES = 1 << 20
BATCH_BYTES = 256 << 30
#: micro-batches of a small input
LEAST_BATCHES = 4
MERGE_SESSIONS = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"
#: marks the end-of-input rows of a staged stream
END = "_end"


class Staged(str):
    """Folder of a staged stream; knows how many files make one chunk."""

    files = 1


def with_end(schema: StructType) -> StructType:
    """``schema`` and the end marker's column."""
    return StructType([*schema.fields, StructField(END, BooleanType())])


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of a folder, from its file system's listing."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(at).getLength()


def data_files(spark: SparkSession, path: str) -> int:
    """Number of data files in a folder."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/part-*")
    return len(at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at) or ())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that this module wrote."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def stage_chunks(spark: SparkSession, df: DataFrame, order: Column, name: str, n_chunks: int | None = None,
                 tail: DataFrame | None = None, sequence: list[int] | None = None, path: str | None = None,
                 cuts: list | None = None) -> Staged:
    """Write ``df`` as ordered appends (ranges of ``order``), then ``tail``
    (end-of-input rows, marked in the column END) as the last one.

    The number of chunks grows with the input (``n_chunks`` fixes it), and
    each chunk is spread over files of at most about FILE_BYTES, one per core
    at least unless they would be smaller than LEAST_FILE_BYTES, which
    ``file_stream`` reads as one micro-batch.  Every chunk has the same number
    of files (empty ones where rows are too few), so no batch holds two.  Cut points come from
    ``approxQuantile`` (one number per chunk reaches the driver), unless
    ``cuts`` gives the last value of every chunk but the last one.
    ``sequence`` gives the order in which chunks are appended (default:
    ascending; tests use it to make late data); ``path`` appends to an
    existing staging folder."""
    path = path or scratch_dir(spark, f"stream-in-{name}")
    # Compute the input once into a table in the shared folder (a lineage
    # cut); quantiles and the chunk writes read it with the range filter
    # pushed into the scan.
    source = scratch_dir(spark, f"stage-src-{name}")
    staged = df.withColumns({"_o": order, END: F.lit(False)})
    _spread(staged, max(spark.sparkContext.defaultParallelism, 1)).write.mode("overwrite").parquet(source)
    size = stored_bytes(spark, source)
    n_chunks = len(cuts) + 1 if cuts is not None else n_chunks or max(LEAST_BATCHES, -(-size // BATCH_BYTES))
    chunk = -(-size // n_chunks)
    cores = max(spark.sparkContext.defaultParallelism, 1)
    files = max(1, -(-chunk // FILE_BYTES), min(cores, -(-chunk // LEAST_FILE_BYTES)))
    keyed = spark.read.parquet(source)
    probs = [i / n_chunks for i in range(1, n_chunks)]
    if cuts is None:
        cuts = sorted(set(keyed.approxQuantile("_o", probs, 0.001))) if n_chunks > 1 else []
    bounds = [None, *cuts, None]
    ranges = list(zip(bounds[:-1], bounds[1:]))
    for lo, hi in (ranges[i] for i in (sequence if sequence is not None else range(len(ranges)))):
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (F.col("_o") > F.lit(lo))
        if hi is not None:
            cond = cond & (F.col("_o") <= F.lit(hi))
        if lo is None:
            cond = cond | F.col("_o").isNull()  # rows without an order value go first
        rows = keyed.where(cond).drop("_o")
        there = data_files(spark, path) if files > 1 else 0
        # the table is spread over files by hash, so its scan's partitions are even without another shuffle
        rows.coalesce(files).write.mode("append").parquet(path)
        for _ in range(there + files - data_files(spark, path) if files > 1 else 0):
            rows.limit(0).write.mode("append").parquet(path)
    if tail is not None:
        _spread(tail.select(*df.columns).withColumn(END, F.lit(True)), 1).write.mode("append").parquet(path)
    remove(spark, source)
    out = Staged(path)
    out.files = files
    return out


def _spread(df: DataFrame, files: int) -> DataFrame:
    """Hash-partition on all columns: deterministic on retry like a sorted
    round-robin, without sorting every row first."""
    return df.repartition(files, F.xxhash64(*df.columns))


def file_stream(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    files = max_files or getattr(path, "files", 1)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def to_event_time(df: DataFrame, col: str) -> DataFrame:
    """Watermarks need TIMESTAMP (not TIMESTAMP_NTZ)."""
    return df.withColumn(col, F.col(col).cast("timestamp"))


def batch_writer(path: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(batch_id).cast("long"))
              .write.mode("overwrite").parquet(f"{path}/batch={batch_id}"))
    return write


def run_to_end(query: StreamingQuery, timeout: int | None = None) -> None:
    """Wait for a stream that ends by itself; ``timeout`` in seconds, none by default."""
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"stream {query.name} did not finish in {timeout}s")
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def state_partitions(spark: SparkSession) -> int:
    """Partitions of a stateful stream (fixed for the life of its
    checkpoint): one per core of the cluster, so every core holds a slice of
    the state and no batch pays for idle state-store instances."""
    return max(spark.sparkContext.defaultParallelism, 1)


def start_with_partitions(spark: SparkSession, writer, partitions: int | None = None) -> StreamingQuery:
    """Start ``writer`` with its state's partitions, and with session windows
    merged in every task before the shuffle; the query clones the session conf
    at start, so the caller's settings are restored right after."""
    settings = {"spark.sql.shuffle.partitions": str(partitions or state_partitions(spark)), MERGE_SESSIONS: "true"}
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        return writer.start()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def run_batches(spark: SparkSession, df: DataFrame, name: str, write: Callable[[DataFrame, int], None],
                ckpt: str | None = None, mode: str = "append") -> None:
    """Run ``df`` to the end of its input through a batch function; ``ckpt`` goes on from an earlier run's checkpoint."""
    ckpt = ckpt or scratch_dir(spark, f"ckpt-{name}")
    run_to_end(start_with_partitions(spark, df.writeStream.foreachBatch(write).outputMode(mode)
                                     .queryName(f"{name}_{ckpt[-6:]}").option("checkpointLocation", ckpt)
                                     .trigger(availableNow=True)))


def run_append(spark: SparkSession, df: DataFrame, name: str, partition_by: list[str] | None = None) -> str:
    """Append-mode query into the parquet file sink; returns the sink path."""
    out = scratch_dir(spark, f"sink-{name}")
    ckpt = scratch_dir(spark, f"ckpt-{name}")
    w = (df.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
           .outputMode("append").trigger(availableNow=True).queryName(f"{name}_{ckpt[-6:]}"))
    if partition_by:
        w = w.partitionBy(*partition_by)
    run_to_end(start_with_partitions(spark, w))
    return out


def run_update(spark: SparkSession, df: DataFrame, name: str) -> str:
    """Update-mode query into per-batch parquet folders; returns the sink path."""
    out = scratch_dir(spark, f"sink-{name}")
    ckpt = scratch_dir(spark, f"ckpt-{name}")
    w = (df.writeStream.foreachBatch(batch_writer(out)).option("checkpointLocation", ckpt)
           .outputMode("update").trigger(availableNow=True).queryName(f"{name}_{ckpt[-6:]}"))
    run_to_end(start_with_partitions(spark, w))
    return out


def read_batches(spark: SparkSession, path: str, schema) -> DataFrame:
    """Read a ``run_update`` sink back (all batches, with ``batch_id``)."""
    from pyspark.sql.types import LongType, StructField, StructType

    # a new StructType: ``StructType.add`` would change the caller's schema
    with_batch = StructType([*schema.fields, StructField("batch_id", LongType())])
    return spark.read.schema(with_batch).parquet(f"{path}/batch=*")
