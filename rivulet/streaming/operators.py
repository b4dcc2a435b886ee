"""Streaming operators: each takes streams and returns a stream.

Inputs may carry the end marker's column (``harness.END``); operators with
event-time state keep marked rows apart by grouping on it, so a reader can
leave them out by that column alone, and no key value is special.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rivulet.operators.joins import interval_join
from rivulet.operators.running import repair_event_time
from rivulet.operators.tables import latest_per_key
from rivulet.session import ensure_state_store
from rivulet.streaming.harness import END, to_event_time
from rivulet.streaming.versions import Versions, commit, committed, read_committed, uncommit

#: event time that co-group state outlives its window, unless the caller says otherwise
RETENTION = "120 seconds"


def _marker(stream: DataFrame) -> list[str]:
    return [END] if END in stream.columns else []


def session_counts(stream: DataFrame, keys: list[str], gap: str, delay: str, ts: str = "ts") -> DataFrame:
    """Session count per key: event time ``ts``, watermark ``delay``, append mode (each session is emitted once, when
    closed). Streams that the harness starts merge the rows of a session in every task before the shuffle, so a hot key
    reaches state as one row per task and session."""
    s = to_event_time(stream, ts).withWatermark(ts, delay)
    return (s.groupBy(*keys, *_marker(s), F.session_window(ts, gap))
             .agg(F.min(ts).alias("session_start"), F.max(ts).alias("session_end"), F.count(F.lit(1)).alias("n"))
             .drop("session_window"))


def running_totals(stream: DataFrame, keys: list[str], totals: list[Column]) -> DataFrame:
    """Totals per key for update mode: partial aggregates in every map task, then one row of state per key. Sums of
    integers stay integers, and a null key is a key."""
    return stream.groupBy(*keys).agg(*totals)


def materialized(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """The aggregate that a stream (``running_totals``, ``latest_change``) keeps in its checkpoint, as a table (keys, then
    state values as ``state``) as of its last batch, or of ``batch_id``: Spark's state data source, no stream runs."""
    reader = spark.read.format("statestore")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    return reader.load(checkpoint).select("key.*", F.col("value").alias("state"))


def reward_days(purchases: DataFrame) -> DataFrame:
    """Update-mode stream of each touched customer's points, purchases, last purchase day and the days between it and the
    purchase day before (0 if there is none). Input: customer_id, points (null: 0), day (days since 1970; purchases
    without one count, but are no purchase day), in any order. A native aggregate: every task reduces its rows to one per
    customer before the shuffle, and the state is one row per customer with the sums and the set of its purchase days
    (at most one entry per calendar day, however many purchases)."""
    rows = purchases.select(F.col("customer_id").cast("string").alias("customer_id"), F.col("day").cast("long").alias("day"),
                            F.coalesce(F.col("points").cast("long"), F.lit(0)).alias("points"))
    latest = F.slice(F.sort_array(F.collect_set("day"), asc=False), 1, 2)
    totals = running_totals(rows, ["customer_id"], [F.sum("points").alias("total_reward_points"),
                                                    F.count(F.lit(1)).alias("n_purchases"), latest.alias("_days")])
    last, before = F.get("_days", F.lit(0)), F.get("_days", F.lit(1))
    return totals.select("customer_id", "total_reward_points", "n_purchases", last.alias("last_day"),
                         F.coalesce(last - before, F.lit(0)).alias("days_from_last_purchase"))


def latest_change(stream: DataFrame, key: str, seq: str, values: list[str]) -> DataFrame:
    """Table to change stream, for update mode: the newest value of each key that a batch touches (a null value is a
    delete, kept as a tombstone)."""
    return (stream.groupBy(key).agg(F.max_by(F.struct(*values, seq), F.col(seq)).alias("_l")).select(key, "_l.*"))


def cogroup(a: DataFrame, b: DataFrame, key: str, ts: str, rid: str, window: str = "1 day",
            retention: str = RETENTION, slot_seconds: int = 900) -> DataFrame:
    """Two streams co-grouped per key and window: rows (key, window_start, part, records_a, records_b), emitted when
    the watermark (``retention`` behind the latest time) passes the window. A key's window is kept in one state row per
    time slot that has records (part: seconds since 1970 of the slot's start), so a list is as long as a slot's records,
    however long the window; ``cogrouped`` puts them together again."""
    def side(s: DataFrame, name: str) -> DataFrame:
        s = to_event_time(s, ts)
        return s.select(F.col(key).alias("key"), F.col(ts).alias("ts"), F.col(rid).alias("rid"),
                        F.lit(name).alias("side"), *_marker(s)).withWatermark("ts", retention)

    both = side(a, "a").unionByName(side(b, "b"))
    record = F.struct("ts", "rid")
    part = (F.floor(F.unix_seconds("ts") / F.lit(slot_seconds)) * F.lit(slot_seconds)).alias("part")
    return (both.groupBy("key", F.window("ts", window), part, *_marker(both))
                .agg(F.collect_list(F.when(F.col("side") == "a", record)).alias("records_a"),
                     F.collect_list(F.when(F.col("side") == "b", record)).alias("records_b"))
                .withColumn("window_start", F.col("window.start")).drop("window"))


def cogrouped(emitted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The records (key, ts, rid) of either side of what ``cogroup`` emitted, for the batch co-group."""
    def side(name: str) -> DataFrame:
        return (emitted.select("key", F.explode(name).alias("r"))
                .select("key", F.col("r.ts").cast("timestamp_ntz").alias("ts"), "r.rid"))

    return side("records_a"), side("records_b")


def daily_counts(stream: DataFrame, ts: str, delay: str, totals: list[Column]) -> DataFrame:
    """Totals per day of the event time ``ts``, emitted once, when the watermark passes the day."""
    s = to_event_time(stream, ts).withWatermark(ts, delay)
    return (s.groupBy(F.window(ts, "1 day"), *_marker(s)).agg(*totals)
             .withColumn("window_start", F.col("window.start")).drop("window"))


def retained_pairs(a: DataFrame, b: DataFrame, key: str, ts: str, rid: str, retention_seconds: int = 120,
                   delay: str = "0 seconds") -> DataFrame:
    """Append-mode stream of the pairs (key, a_id, b_id, a_ms, b_ms) of two streams whose event times are at most the
    retention apart. A stream-stream join on (key, time bucket): records wait in its state, split by buckets, and are
    dropped when the watermark (``delay`` behind the latest time of both sides) has passed all that they could meet; a
    record that comes later meets nobody. The clock is the watermark, which the checkpoint keeps over restarts. Records
    without a key or time pair with none."""
    ensure_state_store(a.sparkSession)
    width = retention_seconds * 1000

    def side(s: DataFrame, name: str) -> DataFrame:
        s = to_event_time(s, ts).where(F.col(key).isNotNull() & F.col(ts).isNotNull())
        ms = F.floor(F.unix_micros(F.col(ts)) / 1000)
        return s.select(F.col(key).cast("string").alias("key"), F.col(ts).alias("ts"), F.col(rid).cast("long").alias("rid"),
                        ms.cast("long").alias("ms"), F.lit(name).alias("side"))

    both = side(a, "a").unionByName(side(b, "b")).withWatermark("ts", delay)

    def one(name: str) -> DataFrame:
        # a condition on ts stays above the watermark, so that both sides have one clock: the latest time of either
        own = both.where(F.when(F.col("ts").isNotNull(), F.col("side")) == name)
        return own.select(*[F.col(c).alias(f"{name}_{c}") for c in ("key", "ts", "rid", "ms")])

    # times count in whole milliseconds, so the join's range is a millisecond wider and the exact one is asked after it
    reach = retention_seconds + 0.001
    met = interval_join(one("a"), one("b"), ("a_key", "b_key"), ("a_ts", "b_ts"), -reach, reach)
    return met.where(F.abs(F.col("b_ms") - F.col("a_ms")) <= width).select(
        F.col("a_key").alias("key"), F.col("a_rid").alias("a_id"), F.col("b_rid").alias("b_id"), "a_ms", "b_ms")


def repair_writer(base: str, schema: StructType, partition: str = "partition", offset: str = "offset",
                  ts_ms: str = "ts_ms") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function of the event-time repair: the batch operator (prefix maxima over buckets of offsets)
    within a micro-batch, and between them a carry, the highest valid time of each partition so far (one row each,
    one version per batch). Repaired rows go to ``<base>/fixed`` (read them by ``versions.read_committed``). Batches must
    hold each partition's records in offset order, as a topic delivers them."""
    carry = Versions(f"{base}/carry", StructType([schema[partition], schema[ts_ms]]))

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            high = carry.before(spark, batch_id)
            of = high.select(F.col(partition).alias("_of"), F.col(ts_ms).alias("_high"))
            fixed = repair_event_time(rows, partition, offset, ts_ms)
            fixed = (fixed.join(of, F.col(partition).eqNullSafe(F.col("_of")), "left")
                     .withColumn("event_ms", F.when(F.col("repaired"), F.greatest("event_ms", "_high"))
                                 .otherwise(F.col("event_ms"))).drop("_of", "_high"))
            uncommit(spark, base, batch_id)
            fixed.write.mode("overwrite").parquet(f"{base}/fixed/batch={batch_id}")
            carry.write(high.unionByName(rows.where(F.col(ts_ms) >= 0).select(partition, ts_ms))
                        .groupBy(partition).agg(F.max(ts_ms).alias(ts_ms)), batch_id)
            commit(spark, base, batch_id)
        finally:
            rows.unpersist()

    return write


def log_writer(base: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that appends a table's changes to its log under ``base``, batch by batch."""
    def write(batch: DataFrame, batch_id: int) -> None:
        uncommit(batch.sparkSession, base, batch_id)
        batch.write.mode("overwrite").parquet(f"{base}/log/batch={batch_id}")
        commit(batch.sparkSession, base, batch_id)

    return write


class MovingTable:
    """A lookup table that follows its change log (``log_writer``): each micro-batch of a stream looks up the newest
    value of each key as of the log's last whole batch when it started. The table is kept as a snapshot with one version
    per batch of the stream, to which only the log's new batches are added, so a replayed batch sees the table that the
    first run saw. ``seq`` orders the changes of a key; null values delete it."""

    def __init__(self, log: str, base: str, schema: StructType, key: str, seq: str):
        self.log, self.schema, self.key, self.seq = log, schema, key, seq
        self.values = [c for c in schema.names if c not in (key, seq)]
        self.table = Versions(f"{base}/table", schema)
        self.seen = Versions(f"{base}/seen", StructType().add("last", "long"))

    def at(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """The table (key, values) for a micro-batch."""
        spark = batch.sparkSession
        if batch_id in committed(spark, self.seen.base):  # a replay
            now = read_committed(spark, self.table.base, "table", self.schema, [batch_id])
        else:
            last = self.seen.before(spark, batch_id).first()
            new = [i for i in committed(spark, self.log) if last is None or i > last["last"]]
            rows = self.table.before(spark, batch_id).unionByName(
                read_committed(spark, self.log, "log", self.schema, new).select(*self.schema.names))
            now = latest_per_key(rows, self.key, self.seq, self.values, keep_deletes=True)
            now = self.table.write(now.select(*self.schema.names), batch_id)
            most = new[-1] if new else last["last"] if last else -1
            self.seen.write(spark.createDataFrame([(most,)], self.seen.schema), batch_id)
        there = F.coalesce(*[F.col(v).cast("string") for v in self.values]).isNotNull()
        return now.where(there).select(self.key, *self.values)


def look_up_writer(base: str, tables: list[tuple[MovingTable, str]]) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that joins each micro-batch (left) with moving tables, each on a column of the stream,
    and writes it to ``<base>/joined``. The planner broadcasts a table if its size allows."""
    def write(batch: DataFrame, batch_id: int) -> None:
        out = batch
        for table, on in tables:
            rows = table.at(batch, batch_id)
            out = out.join(rows.withColumnRenamed(table.key, "_key"), F.col(on) == F.col("_key"), "left").drop("_key")
        uncommit(batch.sparkSession, base, batch_id)
        out.write.mode("overwrite").parquet(f"{base}/joined/batch={batch_id}")
        commit(batch.sparkSession, base, batch_id)

    return write
