"""Record views over the driver tables (see FIXTURES.md).

Each view maps a driver table onto one record type the programs consume:
purchases, trades, transactions for sessions, companies, clients, ticker,
beer sales, and event-pair inputs.  They are plain DataFrame plans; joins
are left to Catalyst/AQE, which broadcasts a side only when its runtime size
is under ``spark.sql.autoBroadcastJoinThreshold`` and sort-merges otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.schemas import PROPS
from rivulet.sources.tables import read_table


def _s(c) -> Column:
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


def _pad4(c: str) -> Column:
    return F.lpad((F.col(c) % 10000).cast("string"), 4, "0")


def name_part(name: str, n: int) -> Column:
    """n-th (1 or 2) ``#``-separated part, as ``split_part`` gives it (empty
    when the part is missing), with ``substring_index`` (no array per row)."""
    c = F.col(name)
    if n == 1:
        return F.substring_index(c, "#", 1)
    has_sep = F.instr(c, "#") > 0
    return (F.when(c.isNull(), F.lit(None).cast("string"))
             .when(has_sep, F.substring_index(F.substring_index(c, "#", 2), "#", -1))
             .otherwise(F.lit("")))


def v_purchase(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey",
                    "l_quantity", "l_discount")
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey")
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_type")
    j = (li.join(o, li.l_orderkey == o.o_orderkey)
           .join(c, o.o_custkey == c.c_custkey)
           .join(p, li.l_partkey == p.p_partkey))
    card = (F.when(F.col("o_orderkey") % 17 == 0, F.concat(F.lit("4"), _s("o_orderkey")))
             .when(F.col("o_orderkey") % 19 == 0, F.lit("1-2-3-"))
             .otherwise(F.concat_ws("-", _pad4("o_custkey"), _pad4("l_partkey"),
                                    _pad4("l_suppkey"), _pad4("o_orderkey"))))
    dept = (F.when(F.col("p_type") == "ECONOMY", F.lit("Coffee"))
             .when(F.col("p_type") == "PROMO", F.lit("ELECTRONICS"))
             .otherwise(F.lower("p_type")))
    employee = (F.when(F.col("l_suppkey") % 20 == 0, F.lit("000000"))
                 .otherwise(F.lpad(_s("l_suppkey"), 6, "0")))
    return j.select(
        name_part("c_name", 1).alias("last_name"),
        name_part("c_name", 2).alias("first_name"),
        _s("o_custkey").alias("customer_id"),
        card.alias("credit_card_number"),
        F.col("p_name").alias("item_purchased"),
        dept.alias("department"),
        employee.alias("employee_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        (F.col("l_discount") * 100).alias("price"),
        F.col("o_orderdate").alias("purchase_date"),
        F.lpad(_s("c_nationkey"), 5, "0").alias("zip_code"),
        _s("l_suppkey").alias("store_id"),
    )


def v_trade(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", "l_partkey", "l_quantity", "l_shipdate")
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_type")
    return (li.join(p, li.l_partkey == p.p_partkey)
              .select(F.concat(F.lit("P"), _s("l_partkey")).alias("symbol"),
                      F.col("p_type").alias("industry"),
                      F.col("l_quantity").cast("int").alias("shares"),
                      F.col("l_shipdate").alias("ts")))


def v_trade_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades as changes of the share volume: each line adds its shares in its year (n 1); a returned line takes them
    back the year after (n -1).  ``period`` is the first of the two years that the change falls in."""
    li = read_table(spark, sf_dir, "lineitem", "l_partkey", "l_quantity", "l_shipdate", "l_returnflag")
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_type")
    shares, year = F.col("l_quantity").cast("long"), F.year("l_shipdate")
    one = lambda sign, when: F.struct((shares * sign).alias("shares"), F.lit(sign).alias("n"), when.alias("year"))
    steps = F.when(F.col("l_returnflag") == "R", F.array(one(1, year), one(-1, year + 1))).otherwise(
        F.array(one(1, year)))
    return (li.join(p, li.l_partkey == p.p_partkey)
              .select(F.concat(F.lit("P"), _s("l_partkey")).alias("symbol"), F.col("p_type").alias("industry"),
                      F.explode(steps).alias("c"))
              .select("symbol", "industry", "c.shares", "c.n", (F.col("c.year") - F.col("c.year") % 2).alias("period")))


def name_changes(names: DataFrame, key: str, number: Column) -> DataFrame:
    """A change log (key, name, seq) of a table of names: all names (seq 0); by the key's number, some get a new name at
    steps 1 and 2, and some are deleted at step 1."""
    steps = (F.when(number % 5 == 1, F.array(F.struct(F.lit(1).alias("seq"), F.concat("name", F.lit(" I")).alias("name"))))
             .when(number % 5 == 2, F.array(F.struct(F.lit(2).alias("seq"), F.concat("name", F.lit(" II")).alias("name"))))
             .when(number % 5 == 3, F.array(F.struct(F.lit(1).alias("seq"), F.lit(None).cast("string").alias("name"))))
             .otherwise(F.array().cast("array<struct<seq:int,name:string>>")))
    first = F.array(F.struct(F.lit(0).alias("seq"), F.col("name").alias("name")))
    return (names.select(key, F.explode(F.concat(first, steps)).alias("c"))
                 .select(key, "c.name", F.col("c.seq").cast("long").alias("seq")))


def v_share_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share volume per symbol, reduced before the dimension join.

    A symbol is one part key, so the sum over trades is taken per
    ``l_partkey`` (partial aggregation in every map task, then one shuffle of
    one row per part per task) and only the per-part totals are joined to
    ``part`` for the industry.  The join never sees the trade rows.
    """
    from rivulet.operators.aggregates import reduce_then_look_up

    li = read_table(spark, sf_dir, "lineitem", "l_partkey", "l_quantity")
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_type")
    shares = F.sum(F.col("l_quantity").cast("int").cast("long")).alias("shares")
    return (reduce_then_look_up(li, "l_partkey", [shares, F.count(F.lit(1)).alias("n")], p, "p_partkey")
            .select(F.concat(F.lit("P"), _s("l_partkey")).alias("symbol"), F.col("p_type").alias("industry"), "shares",
                    "n"))


def v_traded_industries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Industries that have at least one trade: distinct traded part keys
    (partial aggregation in each map task), a semi-join to ``part``, then
    the distinct industries.  The same rows as ``distinct(industry)`` over
    the trade view, without joining every trade."""
    traded = read_table(spark, sf_dir, "lineitem", "l_partkey").distinct()
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_type")
    return (p.join(traded, p.p_partkey == traded.l_partkey, "left_semi")
             .select(F.col("p_type").alias("industry")).distinct())


def props_k(props: Column | str = "props") -> Column:
    """Typed decode of the events ``props`` JSON (``{"k": n}``)."""
    return F.from_json(props, PROPS).getField("k")


def v_txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events", "event_id", "user_id", "props", "event_type", "ts")
    return ev.select(
        "event_id",
        _s("user_id").alias("customer_id"),
        F.concat(F.lit("R"), (props_k() % 6).cast("string")).alias("symbol"),
        F.col("event_type").alias("industry"),
        "ts")


def v_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = read_table(spark, sf_dir, "region", "r_regionkey", "r_name")
    return r.select(F.concat(F.lit("R"), _s("r_regionkey")).alias("symbol"),
                    F.col("r_name").alias("name"))


def v_client(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_name")
    return c.select(_s("c_custkey").alias("customer_id"),
                    F.concat(name_part("c_name", 1), F.lit(", "), name_part("c_name", 2)).alias("name"))


def v_ticker(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events", "user_id", "event_type", "value", "event_id")
    return ev.select(_s("user_id").alias("symbol"),
                     F.when(F.col("event_type") == "error", F.lit(None).cast("double"))
                      .otherwise(F.col("value")).alias("price"),
                     F.col("event_id").alias("seq"))


def v_beer(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", "o_custkey", "o_totalprice", "o_orderkey",
                   "o_orderpriority")
    m = F.col("o_custkey") % 3
    return o.select(
        F.when(m == 0, F.lit("DOLLARS")).when(m == 1, F.lit("EURO")).otherwise(F.lit("POUNDS"))
         .alias("currency"),
        F.col("o_totalprice").alias("total_sale"),
        (F.col("o_orderkey") % 50).cast("int").alias("number_cases"),
        F.col("o_orderpriority").alias("beer_type"))


def v_events_typed(spark: SparkSession, sf_dir: str, event_type: str) -> DataFrame:
    """Events of one type as purchase-like records for pair joins / co-grouping."""
    ev = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type",
                    "value", "props")
    return ev.where(F.col("event_type") == event_type).drop("event_type")
