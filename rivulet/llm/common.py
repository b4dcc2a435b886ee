"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.session import scratch_dir
from rivulet.sources.tables import read_table

#: rows of an Arrow batch that goes to a task's Python side; texts may be long
BATCH_ROWS = 1000
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return read_table(spark, sf_dir, name, *columns)


#: folders that ``cut`` wrote, by the DataFrame that reads them
_FOLDERS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Spark deletes the shuffle files of a query in here when the query ends, not when the driver collects garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def cut(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back: the lineage ends there, and a lost executor
    costs only a re-read."""
    spark = df.sparkSession
    folder = scratch_dir(spark, purpose)
    path = folder + "/table"
    with brief_shuffles(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _FOLDERS[out] = folder
    return out


def release(*tables: DataFrame) -> None:
    """Delete what ``cut`` wrote for these DataFrames. Nothing made of them may be read any more, unless it was cut."""
    for df in tables:
        if folder := _FOLDERS.pop(df, None):
            spark = df.sparkSession
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def bound_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of texts small: the session's batch size is lowered to BATCH_ROWS if it is larger. Results do
    not depend on it."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def packed(df: DataFrame, *own: str) -> tuple[DataFrame, list[Column]]:
    """``df`` as the columns ``own`` and one struct of all others, so that no column of the caller's can clash with those
    an operator adds; and the columns that turn it back."""
    others = [c for c in df.columns if c not in own]
    held = [F.struct(*[F.col(f"`{c}`") for c in others]).alias("_others")] if others else []
    return df.select(*own, *held), [F.col(c) if c in own else F.col("_others").getField(c).alias(c) for c in df.columns]


def partitions(spark: SparkSession) -> int:
    """Shuffle partitions of the session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(column):
    """A-Z lower-cased, everything else as it is."""
    return F.translate(column, UPPER, LOWER)


def extended(batch: pa.RecordBatch, **arrays: pa.Array) -> pa.RecordBatch:
    """``batch`` with further columns."""
    return pa.RecordBatch.from_arrays([*batch.columns, *arrays.values()], names=[*batch.schema.names, *arrays])


def widened(schema: T.StructType, **fields: str) -> T.StructType:
    """``schema`` and further nullable fields, given as name=type."""
    return T.StructType([*schema.fields, *(T.StructField(n, T._parse_datatype_string(t)) for n, t in fields.items())])
