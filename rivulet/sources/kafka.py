"""Kafka adapters: option maps, and reads and writes of a topic in one call.  The connector is a deployment
dependency (``--packages``); the same plans run on parquet file streams in tests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def kafka_source_options(bootstrap: str, topic: str, starting: str = "earliest",
                         max_offsets_per_trigger: int | None = None, fail_on_data_loss: bool = True) -> dict:
    """Options for ``spark.readStream.format("kafka")``.

    ``starting`` is the reset policy (earliest / latest); it applies only when
    the query has no checkpoint yet, as with a consumer group's reset policy.
    Offsets that are gone stop the query unless the caller says otherwise.
    """
    opts = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic,
            "startingOffsets": starting, "failOnDataLoss": str(fail_on_data_loss).lower()}
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return opts


def kafka_sink_options(bootstrap: str, topic: str, acks: str = "all", retries: int = 3,
                       compression: str = "snappy") -> dict:
    """Options for ``writeStream.format("kafka")`` (acks, retries, compression)."""
    return {"kafka.bootstrap.servers": bootstrap, "topic": topic, "kafka.acks": acks,
            "kafka.retries": str(retries), "kafka.compression.type": compression}


def decode_records(raw: DataFrame, schema: StructType, key_type: str = "string") -> DataFrame:
    """Kafka envelope -> typed record columns plus the envelope metadata."""
    return raw.select(F.col("key").cast(key_type).alias("key"),
                      F.from_json(F.col("value").cast("string"), schema).alias("v"),
                      "topic", "partition", "offset", "timestamp").select(
        "key", "v.*", "topic", "partition", "offset", "timestamp")


def encode_records(df: DataFrame, key: Column | str) -> DataFrame:
    """Typed records -> ``key``/``value`` text columns a Kafka sink accepts."""
    key_col = F.col(key) if isinstance(key, str) else key
    value_cols = [c for c in df.columns]
    return df.select(key_col.cast("string").alias("key"),
                     F.to_json(F.struct(*value_cols)).alias("value"))


def read_topic(spark: SparkSession, bootstrap: str, topic: str, schema: StructType, stream: bool = True,
               **options) -> DataFrame:
    """A topic as typed records; keywords as for ``kafka_source_options``."""
    reader = (spark.readStream if stream else spark.read).format("kafka")
    return decode_records(reader.options(**kafka_source_options(bootstrap, topic, **options)).load(), schema)


def write_topic(df: DataFrame, key: Column | str, bootstrap: str, topic: str, checkpoint: str | None = None, **options):
    """Records to a topic: a stream's writer (to be started) if ``df`` is a stream, else the rows are sent now."""
    sink = kafka_sink_options(bootstrap, topic, **options)
    out = encode_records(df, key)
    if df.isStreaming:
        return out.writeStream.format("kafka").options(**sink).option("checkpointLocation", checkpoint)
    out.write.format("kafka").options(**sink).save()
