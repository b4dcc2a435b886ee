"""Folders per micro-batch with commit markers, and small tables kept from batch to batch.

A batch function writes ``<base>/.../batch=<id>`` folders and, last, the marker ``<base>/_commits/<id>``. Readers take
only batches that have one, so a half-written batch is invisible; a replayed batch takes its marker away before it
writes again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

MARKERS = "_commits"


def _at(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def commit(spark: SparkSession, base: str, batch_id: int) -> None:
    """All folders of the batch are written."""
    fs, at = _at(spark, f"{base}/{MARKERS}/{batch_id}")
    fs.create(at, True).close()


def uncommit(spark: SparkSession, base: str, batch_id: int) -> None:
    fs, at = _at(spark, f"{base}/{MARKERS}/{batch_id}")
    fs.delete(at, False)


def committed(spark: SparkSession, base: str) -> list[int]:
    """Ids of the whole batches under ``base``, ascending."""
    fs, at = _at(spark, f"{base}/{MARKERS}")
    return sorted(int(s.getPath().getName()) for s in fs.listStatus(at)) if fs.exists(at) else []


def read_committed(spark: SparkSession, base: str, name: str, schema: StructType | None = None,
                   ids: list[int] | None = None) -> DataFrame:
    """The rows that whole batches (all, or those of ``ids``) have written to ``<base>/<name>``."""
    ids = committed(spark, base) if ids is None else ids
    if not ids and schema is None:
        raise ValueError(f"no batch of {base} is committed, and no schema is given")
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*[f"{base}/{name}/batch={i}" for i in ids]) if ids else spark.createDataFrame([], schema)


class Versions:
    """A table of which every batch may write a new version. A batch reads the newest version of a batch before it, so
    a replay reads what the first run read. Versions that no replay needs are deleted."""

    #: versions kept beside the newest one
    SPARE = 2

    def __init__(self, base: str, schema: StructType):
        self.base, self.schema = base.rstrip("/"), schema

    def before(self, spark: SparkSession, batch_id: int) -> DataFrame:
        ids = [i for i in committed(spark, self.base) if i < batch_id]
        return read_committed(spark, self.base, "table", self.schema, ids[-1:])

    def write(self, df: DataFrame, batch_id: int) -> DataFrame:
        """Write ``df`` as the version of the batch, and read it back."""
        spark = df.sparkSession
        uncommit(spark, self.base, batch_id)
        df.write.mode("overwrite").parquet(f"{self.base}/table/batch={batch_id}")
        commit(spark, self.base, batch_id)
        for old in [i for i in committed(spark, self.base) if i < batch_id][:-self.SPARE]:
            uncommit(spark, self.base, old)
            fs, at = _at(spark, f"{self.base}/table/batch={old}")
            fs.delete(at, True)
        return read_committed(spark, self.base, "table", self.schema, [batch_id])
