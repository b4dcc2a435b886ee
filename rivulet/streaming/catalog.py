"""Streaming query catalog: each key runs a real file stream over data
derived from the driver tables (ordered chunks, one per trigger,
``availableNow``) and returns the sink read back as a DataFrame.

Inputs with event-time state get end-of-input rows, far in the future, as
their last chunk: they move the watermark past every open session or window
so it is emitted; they are marked in a column of their own and left out of
the result by it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.functions import purchase as P
from rivulet.functions.text import ranked_list
from rivulet.functions.timecols import epoch_millis
from rivulet.operators import cogroup as G
from rivulet.operators import records as R
from rivulet.operators.joins import interval_join, interval_join_full_union, join_dimension, pair_purchases
from rivulet.operators.tables import latest_per_key
from rivulet.operators.topk import top_k_by_volume
from rivulet.plans.apps import purchase_flow
from rivulet.plans.catalog import fan_out_summary
from rivulet.session import ensure_state_store, scratch_dir
from rivulet.sources import fixtures as V
from rivulet.sources.sinks import fan_out_writer
from rivulet.sources.tables import read_table
from rivulet.streaming import operators as O
from rivulet.streaming.harness import (END, file_stream, read_batches, run_append, run_batches, run_update,
                                       stage_chunks, to_event_time, with_end)
from rivulet.streaming.ranking import bucket_lists, rank_writer
from rivulet.streaming.versions import read_committed

WATERMARK_DELAY = "24 hours"
SESSION_GAP = "2 days"
SESSION_KEYS = ["customer_id", "symbol", "industry"]


def _utc(spark: SparkSession) -> None:
    # Event-time windows align on UTC; streaming keys run with a UTC session.
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def _ntz(col: str):
    return F.col(col).cast("timestamp_ntz").alias(col)


def end_rows(df: DataFrame, ts: str, **values) -> DataFrame:
    """One end-of-input row ten years after the last ``ts`` of df; other columns are null unless given."""
    far = F.timestamp_add("DAY", F.lit(3650), F.max(ts))
    cols = [far.alias(f.name) if f.name == ts else F.lit(values.get(f.name)).cast(f.dataType).alias(f.name)
            for f in df.schema.fields]
    return df.agg(*cols)


def without_end(df: DataFrame, *flags: str) -> DataFrame:
    flags = flags or (END,)
    return df.where(~F.coalesce(*flags, F.lit(False))).drop(*flags)


def q_source_append(spark: SparkSession, d: str) -> DataFrame:
    ev = read_table(spark, d, "events")
    path = stage_chunks(spark, ev, F.col("event_id"), "events")
    out = run_append(spark, file_stream(spark, path, ev.schema), "source_append")
    return spark.read.parquet(out)


def q_changelog_stream(spark, d):
    """Table -> change stream; the final change per key is read back."""
    tick = V.v_ticker(spark, d)
    path = stage_chunks(spark, tick, F.col("seq"), "ticker")
    changes = O.latest_change(file_stream(spark, path, tick.schema), "symbol", "seq", ["price"])
    out = run_update(spark, changes, "changelog")
    back = read_batches(spark, out, T.StructType(tick.schema.fields))
    return latest_per_key(back, "symbol", "seq", ["price"], keep_deletes=True)


def session_stream(spark: SparkSession, d: str, name: str) -> DataFrame:
    txn = V.v_txn(spark, d)
    path = stage_chunks(spark, txn, F.col("event_id"), name, tail=end_rows(txn, "ts"))
    return O.session_counts(file_stream(spark, path, with_end(txn.schema)), SESSION_KEYS, SESSION_GAP, WATERMARK_DELAY)


def q_session_stream(spark, d):
    _utc(spark)
    return read_sessions(spark, run_append(spark, session_stream(spark, d, "txn"), "sessions"))


def read_sessions(spark: SparkSession, out: str, keys=SESSION_KEYS) -> DataFrame:
    return without_end(spark.read.parquet(out)).select(*keys, _ntz("session_start"), _ntz("session_end"), "n")


def q_topk_stream(spark, d):
    """Share volume per part kept by the stream; the latest totals are looked
    up in the part table and ranked per industry."""
    li = read_table(spark, d, "lineitem", "l_orderkey", "l_partkey", "l_quantity")
    path = stage_chunks(spark, li, F.col("l_orderkey"), "lineitem")
    totals = O.running_totals(file_stream(spark, path, li.schema), ["l_partkey"],
                              [F.sum(F.col("l_quantity").cast("int").cast("long")).alias("shares")])
    back = read_batches(spark, run_update(spark, totals, "topk"), totals.schema)
    volume = latest_per_key(back, "l_partkey", "batch_id", ["shares"])
    part = read_table(spark, d, "part", "p_partkey", "p_type")
    named = volume.join(part, volume.l_partkey == part.p_partkey).select(
        F.col("p_type").alias("industry"), F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("symbol"),
        "shares")
    return top_k_by_volume(named).select("industry", "rank", "symbol", "shares")


def q_reward_stream(spark, d):
    """Reward points and purchases per customer, kept by the stream."""
    pur = V.v_purchase(spark, d).select(
        "customer_id", P.java_int(P.amount()).cast("long").alias("points"),
        F.unix_date(F.to_date("purchase_date")).alias("day"))
    path = stage_chunks(spark, pur, F.col("day"), "purchases")
    totals = O.running_totals(file_stream(spark, path, pur.schema), ["customer_id"],
                              [F.sum("points").alias("total_reward_points"), F.count(F.lit(1)).alias("n_purchases")])
    back = read_batches(spark, run_update(spark, totals, "rewards"), totals.schema)
    last = latest_per_key(back, "customer_id", "batch_id", ["total_reward_points", "n_purchases"], keep_deletes=True)
    return last.select("customer_id", "total_reward_points", "n_purchases")


def q_reward_days_stream(spark, d):
    """Reward points, last purchase day and days since the one before, per customer, kept by the stream."""
    pur = V.v_purchase(spark, d).select("customer_id", P.java_int(P.amount()).cast("long").alias("points"),
                                        F.unix_date(F.to_date("purchase_date")).alias("day"))
    path = stage_chunks(spark, pur, F.col("day"), "reward-days")
    days = O.reward_days(file_stream(spark, path, pur.schema))
    back = read_batches(spark, run_update(spark, days, "reward-days"), days.schema)
    values = [c for c in days.columns if c != "customer_id"]
    last = latest_per_key(back, "customer_id", "batch_id", values, keep_deletes=True)
    return last.select("customer_id", "total_reward_points", "n_purchases",
                       F.date_from_unix_date(F.col("last_day").cast("int")).alias("last_purchase"),
                       F.col("days_from_last_purchase").cast("int").alias("days_from_last_purchase"))


def q_cogroup_stream(spark, d):
    """Clicks and purchases, each a stream of its own, co-grouped per user and
    day; the emitted groups are read back in the batch co-group's form."""
    _utc(spark)
    ev = read_table(spark, d, "events", "event_id", "ts", "user_id", "event_type")
    sides = []
    for kind in ("click", "purchase"):
        one = ev.where(F.col("event_type") == kind)
        path = stage_chunks(spark, one, F.col("event_id"), f"cogroup-{kind}", tail=end_rows(ev, "ts", event_id=0))
        sides.append(file_stream(spark, path, with_end(one.schema)))
    groups = O.cogroup(*sides, "user_id", "ts", "event_id", retention=WATERMARK_DELAY)
    back = without_end(spark.read.parquet(run_append(spark, groups, "cogroup")))
    return G.render(G.cogroup(*O.cogrouped(back), "key", "ts", "rid"))


def q_correlate_purchases_stream(spark, d, how: str = "left"):
    """Stream-stream interval join (left or full outer): a view and the same
    user's purchases within 6 hours after it.  Unmatched rows are emitted
    once the watermark passes their time + 6 h; the end-of-input marker
    (one view and one purchase) moves it past every real row."""
    _utc(spark)
    ensure_state_store(spark)
    ev = read_table(spark, d, "events", "event_id", "ts", "user_id", "event_type", "value", "props")
    ev = ev.where(F.col("event_type").isin("view", "purchase"))
    # the join drops rows without a user before the watermark sees them, so end rows have one; only END marks them
    end = end_rows(ev, "ts", event_type="view", user_id=-1).unionByName(
        end_rows(ev, "ts", event_type="purchase", user_id=-1))
    path = stage_chunks(spark, ev, F.col("event_id"), "pairs", tail=end)
    s = to_event_time(file_stream(spark, path, with_end(ev.schema)), "ts")
    left = (s.where(F.col("event_type") == "view")
             .select(F.col("event_id").alias("l_id"), F.col("ts").alias("l_ts"), F.col("user_id").alias("l_user"),
                     F.col("value").alias("l_value"), F.col("props").alias("l_item"), F.col(END).alias("l_end"))
             .withWatermark("l_ts", WATERMARK_DELAY))
    right = (s.where(F.col("event_type") == "purchase")
              .select(F.col("event_id").alias("r_id"), F.col("ts").alias("r_ts"), F.col("user_id").alias("r_user"),
                      F.col("value").alias("r_value"), F.col("props").alias("r_item"), F.col(END).alias("r_end"))
              .withWatermark("r_ts", WATERMARK_DELAY))
    if how == "full":
        j = interval_join_full_union(left, right, ("l_user", "r_user"), ("l_ts", "r_ts"), 0, 6 * 3600)
    else:
        j = interval_join(left, right, ("l_user", "r_user"), ("l_ts", "r_ts"), 0, 6 * 3600, how="left")
    out = run_append(spark, j.drop("_lb", "_rb"), f"pairs-{how}")
    back = without_end(spark.read.parquet(out), "l_end", "r_end")
    back = (back.withColumn("l_ts", F.col("l_ts").cast("timestamp_ntz"))
                .withColumn("r_ts", F.col("r_ts").cast("timestamp_ntz"))
                .withColumn("l_user", F.col("l_user").cast("string"))
                .withColumn("r_user", F.col("r_user").cast("string")))
    res = pair_purchases(back, {"customer": "l_user", "item": "l_item", "price": "l_value", "ts": "l_ts"},
                         {"customer": "r_user", "item": "r_item", "price": "r_value", "ts": "r_ts"})
    return res.withColumn("items_purchased", F.array_join("items_purchased", "|"))


def q_event_time_repair_stream(spark, d):
    """Invalid record times replaced by the partition time so far: prefix
    maxima within each micro-batch, a carry per partition between them."""
    ev = read_table(spark, d, "events", "event_id", "user_id", "ts")
    rec = ev.select("event_id", (F.col("user_id") % 4).cast("int").alias("partition"),
                    F.col("event_id").alias("offset"),
                    F.when(F.col("event_id") % 7 == 0, F.lit(-1).cast("long"))
                     .otherwise(epoch_millis("ts")).alias("ts_ms"))
    path = stage_chunks(spark, rec, F.col("offset"), "repair")
    base = scratch_dir(spark, "sink-repair")
    run_batches(spark, file_stream(spark, path, rec.schema), "repair", O.repair_writer(base, rec.schema))
    return read_committed(spark, base, "fixed").select("event_id", "partition", "offset", "ts_ms", "event_ms",
                                                       "repaired")


def q_topk_changes_stream(spark, d):
    """Top 5 of each industry as a change stream: trades and returns of trades
    arrive two years at a time, and each batch emits one list per touched industry."""
    changes = V.v_trade_changes(spark, d)
    periods = [r["period"] for r in changes.select("period").distinct().orderBy("period").collect()]
    path = stage_chunks(spark, changes, F.col("period"), "trade-changes", cuts=periods[:-1])
    base = scratch_dir(spark, "sink-topk-changes")
    lists = bucket_lists(file_stream(spark, path, changes.schema), F.col("industry"), F.col("symbol"), F.col("shares"),
                         F.col("n"), mark=F.col("period"))
    run_batches(spark, lists, "topk-changes", rank_writer(base), mode="update")
    entries = F.array_sort(F.collect_list(F.when(F.col("rank") > 0, F.struct("rank", "member", "amount"))))
    return (read_committed(spark, base, "changes").groupBy("batch_id", "mark", "group").agg(entries.alias("_e"))
            .select(F.col("mark").alias("period"), F.col("group").alias("industry"),
                    ranked_list(F.col("_e"), "member", "amount").alias("ranking")))


def q_retained_pairs_stream(spark, d):
    """Clicks and purchases of a user at most two hours apart, paired from
    keyed state whose records live that long."""
    ev = read_table(spark, d, "events", "event_id", "ts", "user_id", "event_type")
    sides = []
    for kind in ("click", "purchase"):
        one = ev.where(F.col("event_type") == kind).drop("event_type")
        path = stage_chunks(spark, one, epoch_millis("ts"), f"retained-{kind}")
        sides.append(file_stream(spark, path, one.schema))
    pairs = O.retained_pairs(*sides, "user_id", "ts", "event_id", retention_seconds=2 * 3600, delay=WATERMARK_DELAY)
    back = spark.read.schema(pairs.schema).parquet(run_append(spark, pairs, "retained"))
    return back.select("key", F.col("a_id").alias("click_id"), F.col("b_id").alias("purchase_id"),
                       (F.col("b_ms") - F.col("a_ms")).alias("after_ms"))


def q_moving_lookup_stream(spark, d):
    """Transactions resolved by company and client tables that change while
    the stream runs: before each part of the month, the tables' logs get their
    next changes, and only transactions after them see these."""
    txn = V.v_txn(spark, d).withColumn("step", F.least(F.floor((F.dayofmonth("ts") - 1) / 10), F.lit(2)).cast("int"))
    logs = {"company": (V.name_changes(V.v_company(spark, d), "symbol", F.substring("symbol", 2, 20).cast("long")), "symbol"),
            "client": (V.name_changes(V.v_client(spark, d), "customer_id", F.col("customer_id").cast("long")),
                       "customer_id")}
    base = scratch_dir(spark, "sink-lookup")
    tables, ckpt = [], {n: scratch_dir(spark, f"ckpt-lookup-{n}") for n in [*logs, "facts"]}
    for name, (log, key) in logs.items():
        log = log.withColumnRenamed("name", f"{name}_name")
        logs[name] = log
        tables.append((O.MovingTable(f"{base}/{name}-log", f"{base}/{name}", log.schema, key, "seq"), key))
    for step in range(3):
        for name, log in logs.items():
            log.where(F.col("seq") == step).write.mode("append").parquet(f"{base}/{name}-in")
            run_batches(spark, file_stream(spark, f"{base}/{name}-in", log.schema, max_files=1000), name,
                        O.log_writer(f"{base}/{name}-log"), ckpt[name])
        txn.where(F.col("step") == step).write.mode("append").parquet(f"{base}/facts-in")
        run_batches(spark, file_stream(spark, f"{base}/facts-in", txn.schema, max_files=1000), "lookup",
                    O.look_up_writer(base, tables), ckpt["facts"])
    return read_committed(spark, base, "joined").select("event_id", "symbol", "customer_id", "company_name", "client_name")


def q_purchase_fanout_stream(spark, d):
    """The purchase flow as one stream with three outputs (masked purchases,
    patterns, rewards) written exactly-once per batch by a ``foreachBatch``
    fan-out; the whole batches are read back and summarised per sink."""
    pur = V.v_purchase(spark, d)
    path = stage_chunks(spark, pur, F.unix_date(F.to_date("purchase_date")), "fanout")
    base = scratch_dir(spark, "sink-fanout")
    run_batches(spark, file_stream(spark, path, pur.schema), "fanout", fan_out_writer(purchase_flow, base))
    return fan_out_summary(*(read_committed(spark, base, n) for n in ("purchases", "patterns", "rewards")))


def q_employee_alerts_stream(spark, d):
    """The watched employee's purchases appended to an alert table, batch by
    batch, as the stream's side effect."""
    shown = ["employee_id", "customer_id", "item_purchased", "price", "quantity", "purchase_date", "store_id"]
    pur = V.v_purchase(spark, d).select(*shown)
    path = stage_chunks(spark, pur, F.unix_date(F.to_date("purchase_date")), "alerts")
    base = scratch_dir(spark, "sink-alerts")
    run_batches(spark, file_stream(spark, path, pur.schema), "alerts",
                fan_out_writer(lambda batch: {"alerts": R.watch_employee(batch)}, base))
    return read_committed(spark, base, "alerts").select(*shown)


def q_purchase_days_stream(spark, d):
    """Purchases per day of the purchase date, which is the event time."""
    _utc(spark)
    pur = V.v_purchase(spark, d).select("quantity", F.col("purchase_date").cast("timestamp_ntz").alias("purchase_date"))
    path = stage_chunks(spark, pur, F.unix_date(F.to_date("purchase_date")), "days",
                        tail=end_rows(pur, "purchase_date"))
    days = O.daily_counts(file_stream(spark, path, with_end(pur.schema)), "purchase_date", WATERMARK_DELAY,
                          [F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("quantity")])
    back = without_end(spark.read.parquet(run_append(spark, days, "days")))
    return back.select(_ntz("window_start"), "n", "quantity")


def q_session_enriched_stream(spark, d):
    """Session counts enriched inside the stream: each closed session is
    joined with the company and client tables (stream-static left joins)."""
    _utc(spark)
    sessions = session_stream(spark, d, "txn-enriched")
    s = join_dimension(sessions, V.v_company(spark, d).withColumnRenamed("name", "company_name"), "symbol")
    s = join_dimension(s, V.v_client(spark, d).withColumnRenamed("name", "customer_name"), "customer_id")
    out = run_append(spark, s, "sessions-enriched")
    back = without_end(spark.read.parquet(out))
    return back.select("customer_id", "symbol", "industry", _ntz("session_start"), _ntz("session_end"), "n",
                       "company_name", "customer_name")


STREAM_QUERIES = {
    "source_append": q_source_append,
    "changelog_stream": q_changelog_stream,
    "session_stream": q_session_stream,
    "topk_stream": q_topk_stream,
    "reward_stream": q_reward_stream,
    "reward_days_stream": q_reward_days_stream,
    "cogroup_stream": q_cogroup_stream,
    "correlate_purchases_stream": q_correlate_purchases_stream,
    "correlate_purchases_full_stream": lambda spark, d: q_correlate_purchases_stream(spark, d, "full"),
    "event_time_repair_stream": q_event_time_repair_stream,
    "topk_changes_stream": q_topk_changes_stream,
    "retained_pairs_stream": q_retained_pairs_stream,
    "moving_lookup_stream": q_moving_lookup_stream,
    "purchase_fanout_stream": q_purchase_fanout_stream,
    "employee_alerts_stream": q_employee_alerts_stream,
    "purchase_days_stream": q_purchase_days_stream,
    "session_enriched_stream": q_session_enriched_stream,
}
