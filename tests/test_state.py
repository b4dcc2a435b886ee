"""Totals kept by a stream: restart from the checkpoint, falling values, null keys, exact integers."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from rivulet.functions import purchase as P
from rivulet.operators.tables import latest_per_key
from rivulet.operators.topk import top_k_by_volume
from rivulet.session import scratch_dir
from rivulet.sources import fixtures as V
from rivulet.streaming.harness import batch_writer, file_stream, read_batches, run_to_end, stage_chunks
from rivulet.streaming.operators import materialized, running_totals


def _run(spark, df, out, ckpt, partitions="8"):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        run_to_end(df.writeStream.foreachBatch(batch_writer(out)).option("checkpointLocation", ckpt)
                   .outputMode("update").trigger(availableNow=True).start())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_totals_survive_a_restart_on_a_cluster_of_another_size(spark):
    pur = V.v_purchase(spark, SF_SMALL).select(
        "customer_id", P.java_int(P.amount()).cast("long").alias("points"),
        F.unix_date(F.to_date("purchase_date")).alias("day"))
    order, totals = F.col("day"), [F.sum("points").alias("points"), F.count(F.lit(1)).alias("n")]
    path = stage_chunks(spark, pur, order, "state-restart", 4, sequence=[0, 1])
    out, ckpt = scratch_dir(spark, "state-out"), scratch_dir(spark, "state-ckpt")
    plan = lambda: running_totals(file_stream(spark, path, pur.schema), ["customer_id"], totals)
    _run(spark, plan(), out, ckpt)
    stage_chunks(spark, pur, order, "state-restart", 4, sequence=[2, 3], path=path)
    _run(spark, plan(), out, ckpt, partitions="3")
    final = latest_per_key(read_batches(spark, out, plan().schema), "customer_id", "batch_id", ["points", "n"])
    got = {r.customer_id: (r.points, r.n) for r in final.collect()}
    want = {r.customer_id: (r.points, r.n) for r in pur.groupBy("customer_id").agg(*totals).collect()}
    assert got == want
    table = materialized(spark, ckpt)
    assert {r.customer_id: tuple(r.state) for r in table.collect()} == want
    first = materialized(spark, ckpt, 0)
    assert first.agg(F.sum("state.count")).first()[0] == read_batches(spark, out, plan().schema).where("batch_id = 0").agg(
        F.sum("n")).first()[0]


def test_null_keys_falling_totals_and_large_integers(spark):
    schema = "industry string, symbol string, shares long"
    first = [("X", f"S{i}", 100 - i) for i in range(7)] + [("X", None, 1), (None, "N", 2**53), ("Y", "B", -5)]
    second = [("X", "S0", -95), ("X", "S1", -90), ("X", None, 1), (None, "N", 1)]
    path = scratch_dir(spark, "totals-in")
    for rows in (first, second):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    s = file_stream(spark, path, spark.createDataFrame([], schema).schema, max_files=1)
    totals = running_totals(s, ["industry", "symbol"], [F.sum("shares").alias("shares")])
    out, ckpt = scratch_dir(spark, "totals-out"), scratch_dir(spark, "totals-ckpt")
    _run(spark, totals, out, ckpt)
    back = read_batches(spark, out, totals.schema)
    last = (back.groupBy("industry", "symbol").agg(F.max_by("shares", "batch_id").alias("shares")))
    got = {(r.industry, r.symbol): r.shares for r in last.collect()}
    assert got[("X", None)] == 2 and got[(None, "N")] == 2**53 + 1 and got[("Y", "B")] == -5
    top = [(r.symbol, r.shares) for r in top_k_by_volume(last).where("industry = 'X'").orderBy("rank").collect()]
    assert top == [("S2", 98), ("S3", 97), ("S4", 96), ("S5", 95), ("S6", 94)]


def test_progress_rows_are_kept_without_a_cap_and_once_per_batch(spark):
    from types import SimpleNamespace

    from rivulet.streaming.listener import ProgressLog, logged

    folder = scratch_dir(spark, "progress-folder")
    log = ProgressLog(keep=3, spark=spark, folder=folder)
    for batch in [*range(8), 7, 6]:  # the last two are reported again
        progress = SimpleNamespace(name="q", id="0-1", batchId=batch, numInputRows=10 * batch, batchDuration=5,
                                   observedMetrics={"sink": SimpleNamespace(asDict=lambda: {"rows": 1})})
        log.onQueryProgress(SimpleNamespace(progress=progress))
    assert len(log.rows) == 3
    assert sorted((r.query, r.batch_id, r.input_rows) for r in logged(spark, folder).collect()) == [
        ("q", i, 10 * i) for i in range(8)]
