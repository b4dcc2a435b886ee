"""Kafka envelope handling, option maps, labelled output, plan description."""

import datetime as dt

from pyspark.sql import functions as F

from rivulet.operators.monitoring import describe
from rivulet.schemas import BEER_PURCHASE
from rivulet.sources.kafka import decode_records, encode_records, kafka_sink_options, kafka_source_options
from rivulet.sources.sinks import labelled


def _envelope(spark):
    rows = [("k1", '{"currency":"EURO","total_sale":10.9,"number_cases":2,"beer_type":"ale"}', "t", 0, 5,
             dt.datetime(2024, 1, 1)),
            ("k2", "garbage", "t", 1, 7, dt.datetime(2024, 1, 1))]
    df = spark.createDataFrame(rows, "k string, v string, topic string, partition int, offset long, timestamp timestamp")
    return df.select(F.col("k").cast("binary").alias("key"), F.col("v").cast("binary").alias("value"),
                     "topic", "partition", "offset", "timestamp")


def test_decode_and_encode_kafka_envelope(spark):
    dec = decode_records(_envelope(spark), BEER_PURCHASE)
    got = {r.key: (r.currency, r.total_sale, r.offset, r.partition) for r in dec.collect()}
    assert got == {"k1": ("EURO", 10.9, 5, 0), "k2": (None, None, 7, 1)}
    enc = encode_records(dec.where("currency is not null").select(*BEER_PURCHASE.fieldNames()), "currency")
    back = decode_records(enc.withColumn("topic", F.lit("t")).withColumn("partition", F.lit(0))
                          .withColumn("offset", F.lit(0).cast("long"))
                          .withColumn("timestamp", F.current_timestamp()), BEER_PURCHASE)
    assert [(r.key, r.number_cases, r.beer_type) for r in back.collect()] == [("EURO", 2, "ale")]


def test_option_maps():
    src = kafka_source_options("b:9092", "purchases", starting="latest", max_offsets_per_trigger=1000)
    assert src["subscribe"] == "purchases" and src["startingOffsets"] == "latest"
    assert src["maxOffsetsPerTrigger"] == "1000" and src["failOnDataLoss"] == "true"
    assert kafka_source_options("b:9092", "t", fail_on_data_loss=False)["failOnDataLoss"] == "false"
    sink = kafka_sink_options("b:9092", "patterns")
    assert sink["topic"] == "patterns" and sink["kafka.acks"] == "all"
    assert sink["kafka.compression.type"] == "snappy"


def test_labelled_print_and_describe(spark):
    df = spark.range(3)
    out = labelled(df, "ticker-table")
    assert out.columns == ["label", "id"] and {r.label for r in out.collect()} == {"ticker-table"}
    assert "Range" in describe(df)
