"""Batch query catalog: one entry per operator of the survey, each a
function ``(spark, sf_dir) -> DataFrame`` over the driver tables.

Column names and types match the oracle SQL in ``rivulet.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.functions import purchase as P
from rivulet.functions.timecols import epoch_millis, time_source, trade_event_time
from rivulet.operators import aggregates as A
from rivulet.operators import records as R
from rivulet.operators.cogroup import cogroup, render
from rivulet.operators.joins import interval_join, join_dimension, pair_purchases
from rivulet.operators.monitoring import progress_percent
from rivulet.operators.running import repair_event_time, reward_running_totals
from rivulet.operators.sessions import sessionize
from rivulet.operators.tables import latest_per_key
from rivulet.operators.topk import render_ranked, top_k_by_volume
from rivulet.plans.apps import purchase_flow
from rivulet.schemas import PROPS, PURCHASE
from rivulet.session import scratch_dir
from rivulet.sources import fixtures as V
from rivulet.sources.sinks import write_outputs
from rivulet.sources.tables import read_table

SESSION_GAP_SECONDS = 2 * 24 * 3600
PAIR_WINDOW_SECONDS = 6 * 3600
AUDIT_PARTITIONS = 4
PURCHASE_COLUMNS = [f.name for f in PURCHASE.fields]


def q_map_upper(spark: SparkSession, d: str) -> DataFrame:
    part = read_table(spark, d, "part", "p_partkey", "p_name")
    return R.map_upper(part.select(F.col("p_partkey").alias("key"), F.col("p_name").alias("value")))


def q_mask_card(spark, d):
    return R.mask_purchases(V.v_purchase(spark, d)).select(*PURCHASE_COLUMNS)


def q_purchase_pattern(spark, d):
    return R.purchase_patterns(R.mask_purchases(V.v_purchase(spark, d)))


def q_purchase_reward(spark, d):
    return R.purchase_rewards(R.mask_purchases(V.v_purchase(spark, d)))


def q_purchase_fanout(spark, d):
    """The purchase flow writes its three outputs from one shared upstream;
    each table is read back and summarised."""
    paths = write_outputs(V.v_purchase(spark, d), purchase_flow, scratch_dir(spark, "fanout"))
    return fan_out_summary(*(spark.read.parquet(paths[n]) for n in ("purchases", "patterns", "rewards")))


def fan_out_summary(purchases: DataFrame, patterns: DataFrame, rewards: DataFrame) -> DataFrame:
    """Records and a checksum per output of the purchase flow."""
    def one(df, name, metric):
        return df.agg(F.lit(name).alias("sink"), F.count(F.lit(1)).alias("n_records"), metric.alias("checksum"))

    short = F.sum(F.when(F.col("credit_card_number") == P.CARD_MASK_SHORT, 1).otherwise(0)).cast("double")
    return (one(purchases, "purchases", short)
            .unionByName(one(patterns, "patterns", F.sum(F.col("amount").cast("decimal(38,4)")).cast("double")))
            .unionByName(one(rewards, "rewards", F.sum(F.col("current_reward_points").cast("long")).cast("double"))))


def q_filter_rekey(spark, d):
    return (R.filter_and_rekey_by_time(V.v_purchase(spark, d))
             .select("key", "customer_id", "item_purchased", "price", "quantity", "purchase_date"))


def q_employee_watch(spark, d):
    return (R.watch_employee(V.v_purchase(spark, d))
             .select("employee_id", "customer_id", "item_purchased", "price", "quantity",
                     "purchase_date", "store_id"))


def q_branch_department(spark, d):
    return (R.branch_by_department(V.v_purchase(spark, d))
             .select("branch", "customer_id", "department", "item_purchased", "price", "quantity"))


def q_to_dollars(spark, d):
    b = V.v_beer(spark, d)
    return b.withColumn("dollars", P.to_dollars("total_sale", "currency"))


def q_route_sales(spark, d):
    return R.route_sales(V.v_beer(spark, d))


def q_json_encode(spark, d):
    """Purchases as JSON text (some without a department): the text's field
    names and some of its fields, read from the text."""
    pur = V.v_purchase(spark, d).withColumn("department", F.when(F.col("quantity") % 7 != 0, F.col("department")))
    text = R.json_encode(pur, "customer_id", PURCHASE_COLUMNS)
    read = text.select("key", F.from_json("value", "map<string,string>").alias("m"))  # one parse a row
    names = ["last_name", "first_name", "credit_card_number", "department", "zip_code"]
    return read.select("key", F.array_join(F.map_keys("m"), ",").alias("fields"),
                       *[F.col("m")[n].alias(n) for n in names], F.col("m")["quantity"].cast("int").alias("quantity"),
                       F.col("m")["price"].cast("double").alias("price"))


def q_json_decode(spark, d):
    """Every eleventh text is broken, so both outcomes occur."""
    ev = read_table(spark, d, "events", "event_id", "user_id", "props")
    ev = ev.withColumn("props", F.when(F.col("event_id") % 11 == 0, F.concat(F.lit("broken "), "props"))
                       .otherwise(F.col("props")))
    return (R.json_decode(ev.withColumnRenamed("props", "value"), PROPS)
             .withColumnRenamed("_malformed", "malformed"))


def _event_records(spark, d) -> DataFrame:
    ev = read_table(spark, d, "events", "event_id", "user_id", "event_type")
    return ev.select(F.col("user_id").cast("string").alias("key"), F.col("event_type").alias("value"),
                     F.col("event_id").alias("offset"),
                     (F.col("user_id") % AUDIT_PARTITIONS).cast("int").alias("partition"))


def q_record_audit_line(spark, d):
    return R.audit_lines(_event_records(spark, d))


def q_partition_by_customer(spark, d, num_partitions: int = 16):
    """Records and customers per partition, by the partition they are in;
    purchases of every tenth store come without a customer."""
    store = F.col("store_id").cast("long")
    pur = V.v_purchase(spark, d).select(F.when(store % 10 != 0, F.col("customer_id")).alias("customer_id"), "store_id")
    p = R.partition_by_key(pur, "customer_id", num_partitions, store)
    return (p.withColumn("partition", F.spark_partition_id())
             .groupBy("partition", "customer_id").agg(F.count(F.lit(1)).alias("n"))
             .groupBy("partition").agg(F.sum("n").alias("n_records"), F.count("customer_id").alias("n_customers")))


def q_key_by_function(spark, d):
    """Trades reduced per part before the symbol is looked up and made the key."""
    return R.key_by(V.v_share_volume(spark, d), F.col("symbol")).select("key", "n", "shares")


def q_composite_key_count(spark, d):
    k = R.composite_key(V.v_purchase(spark, d))
    return (A.keyed_count(k, ["purchase_key"])
             .select("purchase_key.customer_id", "purchase_key.transaction_date", "n"))


def q_table_latest(spark, d):
    return latest_per_key(V.v_ticker(spark, d), "symbol", "seq", ["price"])


def q_dim_clients(spark, d):
    return V.v_client(spark, d)


def q_dim_companies(spark, d):
    p = read_table(spark, d, "part", "p_partkey", "p_name", "p_type")
    return p.select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("symbol"),
                    F.col("p_name").alias("name"), F.col("p_type").alias("industry"))


def q_distinct_industries(spark, d):
    return V.v_traded_industries(spark, d)


def q_headline_per_industry(spark, d):
    industries = V.v_traded_industries(spark, d)
    docs = read_table(spark, d, "documents", "doc_id", "text")
    return (A.pair_by_rank(industries, "industry", docs, "doc_id", ["doc_id", "text"])
             .withColumnRenamed("text", "headline"))


def q_reduce_share_volume(spark, d):
    """Share volume per symbol.  ``A.reduce_share_volume`` over the trade
    view gives the same rows; the plan here reduces before the part join."""
    return V.v_share_volume(spark, d).drop("n")


def q_topk_rows(spark, d):
    return (top_k_by_volume(V.v_share_volume(spark, d))
             .select("industry", "rank", "symbol", "shares"))


def q_topk_by_industry(spark, d):
    return render_ranked(top_k_by_volume(V.v_share_volume(spark, d)))


def q_session_count(spark, d):
    return sessionize(V.v_txn(spark, d), ["customer_id", "symbol", "industry"], "ts",
                      SESSION_GAP_SECONDS)


def q_session_by_industry(spark, d):
    """Session counts re-keyed by industry, the count in the value."""
    return R.key_by(q_session_count(spark, d), F.col("industry")).select(
        "key", F.struct("customer_id", "symbol", "n").alias("value"), "session_start", "session_end").select(
        "key", "value.*", "session_start", "session_end")


def q_session_enriched(spark, d):
    s = q_session_count(spark, d)
    s = join_dimension(s, V.v_company(spark, d).withColumnRenamed("name", "company_name"), "symbol")
    return join_dimension(s, V.v_client(spark, d).withColumnRenamed("name", "customer_name"),
                          "customer_id")


def q_event_time(spark, d):
    """Every fifth record is no trade, so all three sources of time occur."""
    ev = read_table(spark, d, "events", "event_id", "ts", "props")
    is_trade = V.props_k("props").isNotNull() & (F.col("event_id") % 5 != 0)
    wall = F.lit("2030-01-01 00:00:00").cast("timestamp_ntz")
    trade_ts = F.when(F.col("event_id") % 7 == 0, F.lit(None)).otherwise(F.col("ts"))
    record_ts = F.date_trunc("minute", F.col("ts")).cast("timestamp_ntz")
    return ev.select("event_id", time_source(is_trade, trade_ts).alias("time_source"),
                     trade_event_time(is_trade, trade_ts, record_ts, wall).alias("event_time"))


def q_event_time_repair(spark, d):
    ev = read_table(spark, d, "events", "event_id", "user_id", "ts")
    rec = ev.select("event_id", (F.col("user_id") % AUDIT_PARTITIONS).cast("int").alias("partition"),
                    F.col("event_id").alias("offset"),
                    F.when(F.col("event_id") % 7 == 0, F.lit(-1).cast("long"))
                     .otherwise(epoch_millis("ts")).alias("ts_ms"))
    return (repair_event_time(rec)
            .select("event_id", "partition", "offset", "ts_ms", "event_ms", "repaired"))


def _pair_sides(spark, d):
    left = V.v_events_typed(spark, d, "view").select(
        F.col("event_id").alias("l_id"), F.col("ts").alias("l_ts"), F.col("user_id").alias("l_user"),
        F.col("value").alias("l_value"), F.col("props").alias("l_item"))
    right = V.v_events_typed(spark, d, "purchase").select(
        F.col("event_id").alias("r_id"), F.col("ts").alias("r_ts"), F.col("user_id").alias("r_user"),
        F.col("value").alias("r_value"), F.col("props").alias("r_item"))
    return left, right


def correlate_purchases(spark, d, how: str) -> DataFrame:
    left, right = _pair_sides(spark, d)
    j = interval_join(left, right, ("l_user", "r_user"), ("l_ts", "r_ts"), 0, PAIR_WINDOW_SECONDS,
                      how=how, right_id="r_id")
    j = j.withColumn("l_user", F.col("l_user").cast("string")).withColumn("r_user", F.col("r_user").cast("string"))
    out = pair_purchases(j, {"customer": "l_user", "item": "l_item", "price": "l_value", "ts": "l_ts"},
                         {"customer": "r_user", "item": "r_item", "price": "r_value", "ts": "r_ts"})
    return out.withColumn("items_purchased", F.array_join("items_purchased", "|"))


def q_cogroup_events(spark, d):
    ev = read_table(spark, d, "events", "event_id", "ts", "user_id", "event_type")
    clicks = ev.where(F.col("event_type") == "click")
    buys = ev.where(F.col("event_type") == "purchase")
    return render(cogroup(clicks, buys, "user_id", "ts", "event_id"))


def q_reward_running_total(spark, d):
    return reward_running_totals(V.v_purchase(spark, d))


def q_progress_percent(spark, d):
    ev = read_table(spark, d, "events", "user_id", "ts")
    return progress_percent(ev, (F.col("user_id") % AUDIT_PARTITIONS).cast("int"), F.to_date("ts"))


BATCH_QUERIES = {
    "map_upper": q_map_upper,
    "mask_card": q_mask_card,
    "purchase_pattern": q_purchase_pattern,
    "purchase_reward": q_purchase_reward,
    "purchase_fanout": q_purchase_fanout,
    "filter_rekey": q_filter_rekey,
    "employee_watch": q_employee_watch,
    "branch_department": q_branch_department,
    "to_dollars": q_to_dollars,
    "route_sales": q_route_sales,
    "json_encode": q_json_encode,
    "json_decode": q_json_decode,
    "record_audit_line": q_record_audit_line,
    "partition_by_customer": q_partition_by_customer,
    "key_by_function": q_key_by_function,
    "composite_key_count": q_composite_key_count,
    "table_latest": q_table_latest,
    "dim_clients": q_dim_clients,
    "dim_companies": q_dim_companies,
    "distinct_industries": q_distinct_industries,
    "headline_per_industry": q_headline_per_industry,
    "reduce_share_volume": q_reduce_share_volume,
    "topk_rows": q_topk_rows,
    "topk_by_industry": q_topk_by_industry,
    "session_count": q_session_count,
    "session_by_industry": q_session_by_industry,
    "session_enriched": q_session_enriched,
    "event_time": q_event_time,
    "event_time_repair": q_event_time_repair,
    "correlate_purchases_inner": lambda s, d: correlate_purchases(s, d, "inner"),
    "correlate_purchases_left": lambda s, d: correlate_purchases(s, d, "left"),
    "correlate_purchases_full": lambda s, d: correlate_purchases(s, d, "full"),
    "cogroup_events": q_cogroup_events,
    "reward_running_total": q_reward_running_total,
    "progress_percent": q_progress_percent,
}
