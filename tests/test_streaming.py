"""Streaming behaviour: restart from a checkpoint, late data, progress rows."""

import datetime as dt
import time

from pyspark.sql import functions as F

from conftest import SF_SMALL
from rivulet.operators.sessions import sessionize
from rivulet.session import scratch_dir
from rivulet.sources import fixtures as V
from rivulet.streaming.catalog import SESSION_GAP, SESSION_KEYS, end_rows, read_sessions, without_end
from rivulet.operators.cogroup import cogroup as batch_cogroup
from rivulet.streaming import operators as O
from rivulet.streaming.harness import file_stream, run_append, run_to_end, stage_chunks, to_event_time, with_end
from rivulet.streaming.listener import ProgressLog
from rivulet.operators.monitoring import observed

GAP_S = 2 * 24 * 3600


def _end_marker(txn):
    return end_rows(txn, "ts")


def _start(spark, path, schema, out, ckpt, delay="24 hours"):
    q = (O.session_counts(file_stream(spark, path, with_end(schema)), SESSION_KEYS, SESSION_GAP, delay)
         .writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
         .outputMode("append").trigger(availableNow=True).start())
    run_to_end(q)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_restart_from_checkpoint_gives_same_answer(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    txn = V.v_txn(spark, SF_SMALL)
    path = stage_chunks(spark, txn, F.col("event_id"), "restart", 4, sequence=[0, 1])
    out, ckpt = scratch_dir(spark, "restart-out"), scratch_dir(spark, "restart-ckpt")
    _start(spark, path, txn.schema, out, ckpt)
    stage_chunks(spark, txn, F.col("event_id"), "restart", 4, sequence=[2, 3], path=path,
                 tail=_end_marker(txn))
    _start(spark, path, txn.schema, out, ckpt)
    expected = sessionize(txn, ["customer_id", "symbol", "industry"], "ts", GAP_S)
    assert _rows(read_sessions(spark, out)) == _rows(expected)


def test_late_rows_are_dropped_and_counted(spark):
    """Tumbling-window counts with a 1 hour watermark over chunks fed out of
    order: rows of a window that already closed are dropped and reported;
    kept + dropped is the whole input.  (Spark's session windows instead keep
    such rows as separate sessions, so sessions are tested for order only.)"""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ev = V.v_events_typed(spark, SF_SMALL, "click").select("event_id", "user_id", "ts")
    end = ev.agg(F.max("event_id").alias("m"), F.max("ts").alias("t")).select(
        (F.col("m") + 1).alias("event_id"), F.lit(-1).cast("long").alias("user_id"),
        F.timestamp_add("DAY", F.lit(3650), F.col("t")).alias("ts"))
    # Late rows are judged against the previous batch's watermark, so the
    # late chunk arrives two batches after its successors.
    path = stage_chunks(spark, ev, F.col("event_id"), "late", 4, sequence=[0, 2, 3, 1], tail=end)
    s = to_event_time(file_stream(spark, path, ev.schema), "ts").withWatermark("ts", "1 hour")
    counts = s.groupBy("user_id", F.window("ts", "1 day")).agg(F.count(F.lit(1)).alias("n"))
    out, ckpt = scratch_dir(spark, "late-out"), scratch_dir(spark, "late-ckpt")
    q = (counts.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
         .outputMode("append").trigger(availableNow=True).start())
    run_to_end(q)
    dropped = sum(op.numRowsDroppedByWatermark for p in q.recentProgress for op in p.stateOperators)
    kept = spark.read.parquet(out).where("user_id <> -1").agg(F.sum("n")).first()[0]
    # The operator counts dropped rows after map-side partial aggregation, so
    # ``dropped`` is at most the number of input rows lost.
    total = ev.count()
    late_chunk = total - kept
    assert dropped > 0 and 0 < late_chunk and dropped <= late_chunk
    assert late_chunk <= total // 4 + 1


def test_sessions_out_of_order_keep_every_row(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    txn = V.v_txn(spark, SF_SMALL)
    path = stage_chunks(spark, txn, F.col("event_id"), "late-s", 4, sequence=[0, 2, 1, 3],
                        tail=_end_marker(txn))
    out, ckpt = scratch_dir(spark, "late-s-out"), scratch_dir(spark, "late-s-ckpt")
    _start(spark, path, txn.schema, out, ckpt, delay="1 hour")
    assert read_sessions(spark, out).agg(F.sum("n")).first()[0] == txn.count()


def test_progress_log_records_observed_metrics(spark):
    log = ProgressLog()
    spark.streams.addListener(log)
    try:
        ev = V.v_ticker(spark, SF_SMALL)
        path = stage_chunks(spark, ev, F.col("seq"), "progress", 3)
        s = observed(file_stream(spark, path, ev.schema), "sink",
                     F.count(F.lit(1)).alias("rows"), F.count("price").alias("priced"))
        out, ckpt = scratch_dir(spark, "progress-out"), scratch_dir(spark, "progress-ckpt")
        q = (s.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
             .trigger(availableNow=True).start())
        run_to_end(q)
        # listener events are delivered asynchronously
        time.sleep(2)
    finally:
        spark.streams.removeListener(log)
    rows = [r for r in log.rows if r.get("sink.rows") is not None]
    assert sum(r["sink.rows"] for r in rows) == ev.count()
    assert len(rows) >= 3 and log.failed == 0
    folder, n = scratch_dir(spark, "progress-log"), len(log.rows)
    assert log.write(spark, folder) == n and not log.rows and spark.read.json(folder).count() == n


def test_staging_keeps_every_row(spark):
    df = spark.createDataFrame([(i, None if i % 10 == 0 else i) for i in range(100)], "id long, o long")
    path = stage_chunks(spark, df, F.col("o"), "staging-nulls", 4)
    back = spark.read.parquet(path)
    assert sorted(r.id for r in back.collect()) == list(range(100))


def _events(spark, rows, kind="ts timestamp_ntz"):
    return spark.createDataFrame(rows, f"event_id long, user_id long, {kind}")


def test_sessions_keep_null_and_special_keys(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    t = dt.datetime(2024, 1, 1)
    rows = [(1, None, t), (2, None, t + dt.timedelta(minutes=5)), (3, -1, t), (4, 7, t)]
    ev = _events(spark, rows)
    path = stage_chunks(spark, ev, F.col("event_id"), "null-keys", 2, tail=end_rows(ev, "ts"))
    s = O.session_counts(file_stream(spark, path, with_end(ev.schema)), ["user_id"], "1 hour", "1 hour")
    got = read_sessions(spark, run_append(spark, s, "null-keys"), ["user_id"])
    assert sorted(((r.user_id, r.n) for r in got.collect()), key=str) == [(-1, 1), (7, 1), (None, 2)]
    assert sorted(((r.user_id, r.n) for r in sessionize(ev, ["user_id"], "ts", 3600).collect()), key=str) == [
        (-1, 1), (7, 1), (None, 2)]


def test_cogroup_of_two_streams_equals_batch_with_a_hot_and_a_null_key(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    t = dt.datetime(2024, 1, 1)
    key = lambda i: None if i % 10 == 0 else -1 if i % 10 == 1 else 5 if i % 3 else i % 7
    sides = [_events(spark, [(2 * i + k, key(i), t + dt.timedelta(minutes=17 * i)) for i in range(200)])
             for k in range(2)]
    streams = []
    for k, side in enumerate(sides):
        path = stage_chunks(spark, side, F.col("event_id"), f"co-{k}", 3, tail=end_rows(side, "ts", event_id=0))
        streams.append(file_stream(spark, path, with_end(side.schema)))
    out = run_append(spark, O.cogroup(*streams, "user_id", "ts", "event_id", retention="2 days"), "co")
    back = O.cogrouped(without_end(spark.read.parquet(out)))
    got = batch_cogroup(*back, "key", "ts", "rid", chunk_size=20)
    want = batch_cogroup(*sides, "user_id", "ts", "event_id", chunk_size=20)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))
    assert got.agg(F.sum("n_a"), F.sum("n_b")).first() == (200, 200)
