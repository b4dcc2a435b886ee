"""Stateless per-record operators: projections, re-keying, filters, routing,
partitioning and JSON coding.  None of them shuffles except the explicit
re-partition in ``partition_by_key``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions import purchase as P
from rivulet.functions.text import audit_line
from rivulet.functions.timecols import epoch_millis

# Fixed values that must equal the reference's.
PRICE_FLOOR = 5.00
WATCHED_EMPLOYEE = "000000"
BRANCHES = ("coffee", "electronics")


def map_upper(df: DataFrame, value: str = "value") -> DataFrame:
    return df.withColumn(value, F.upper(F.col(value)))


def mask_purchases(purchases: DataFrame) -> DataFrame:
    return purchases.withColumn("credit_card_number", P.mask_card("credit_card_number"))


def purchase_patterns(purchases: DataFrame) -> DataFrame:
    return purchases.select("zip_code", F.col("item_purchased").alias("item"),
                            F.col("purchase_date").alias("date"),
                            P.amount().alias("amount"))


def purchase_rewards(purchases: DataFrame) -> DataFrame:
    """One reward record per purchase.  The total equals the current points:
    the accumulation call is never made on this path (see running totals)."""
    total = P.amount()
    points = P.java_int(total)
    return purchases.select(P.reward_customer().alias("customer_id"),
                            total.alias("purchase_total"),
                            points.alias("total_reward_points"),
                            points.alias("current_reward_points"),
                            F.lit(0).alias("days_from_last_purchase"))


def key_by(df: DataFrame, key: Column, name: str = "key") -> DataFrame:
    """Attach a key computed by a caller-supplied expression."""
    return df.withColumn(name, key)


def filter_and_rekey_by_time(purchases: DataFrame, floor: float = PRICE_FLOOR) -> DataFrame:
    """Keep purchases priced strictly above ``floor``; key them by purchase
    time in epoch milliseconds.  The filter precedes the re-key so it can be
    pushed down to the scan."""
    return (purchases.where(F.col("price") > F.lit(floor))
                     .withColumn("key", epoch_millis("purchase_date")))


def watch_employee(purchases: DataFrame, employee_id: str = WATCHED_EMPLOYEE) -> DataFrame:
    return purchases.where(F.col("employee_id") == F.lit(employee_id))


def branch(df: DataFrame, predicates: list[tuple[str, Column]], name: str = "branch") -> DataFrame:
    """Ordered predicates, first match wins, rows matching none are dropped.
    Write the result with ``partitionBy(name)`` to get one output per branch."""
    expr = None
    for label, pred in predicates:
        expr = F.when(pred, F.lit(label)) if expr is None else expr.when(pred, F.lit(label))
    return df.withColumn(name, expr).where(F.col(name).isNotNull())


def branch_by_department(purchases: DataFrame) -> DataFrame:
    dept = F.lower(F.col("department"))
    return branch(purchases, [(b, dept == F.lit(b)) for b in BRANCHES])


def route_sales(sales: DataFrame) -> DataFrame:
    """Domestic (dollar) sales pass through; others are converted to dollars
    and routed to the international output."""
    domestic = F.col("currency") == F.lit("DOLLARS")
    return sales.select(
        F.when(domestic, F.lit("domestic")).otherwise(F.lit("international")).alias("route"),
        "currency", "total_sale", "number_cases", "beer_type",
        P.to_dollars("total_sale", "currency").alias("dollars"))


def partition_column(key: Column, num_partitions: int, spread: Column) -> Column:
    """Explicit partition number: a numeric key modulo the number of partitions, any other key by hash; records without
    a key are spread by ``spread`` (a number that differs between records)."""
    number = key.try_cast("bigint")
    return F.pmod(F.when(key.isNull(), spread.cast("long")).otherwise(F.coalesce(number, F.hash(key).cast("long"))),
                  F.lit(num_partitions)).cast("int")


def partition_by_key(df: DataFrame, key: str, num_partitions: int, spread: Column) -> DataFrame:
    """All records of one key land in the partition that ``partition_column`` names; records without a key are spread
    over all of them.  One shuffle."""
    return df.repartitionById(num_partitions, partition_column(F.col(key), num_partitions, spread))


def composite_key(df: DataFrame, name: str = "purchase_key") -> DataFrame:
    return df.withColumn(name, F.struct(F.col("customer_id"),
                                        F.col("purchase_date").alias("transaction_date")))


def json_encode(df: DataFrame, key: str, value_cols: list[str] | None = None) -> DataFrame:
    cols = value_cols or df.columns
    return df.select(F.col(key).cast("string").alias("key"),
                     F.to_json(F.struct(*cols)).alias("value"))


def json_decode(df: DataFrame, schema, value: str = "value") -> DataFrame:
    """Typed decode; a malformed record yields null fields (PERMISSIVE) and
    is flagged in ``_malformed`` through the corrupt-record column instead of
    failing the job."""
    from pyspark.sql.types import StringType, StructField, StructType

    corrupt = "_corrupt_record"
    with_corrupt = StructType([*schema.fields, StructField(corrupt, StringType())])
    parsed = F.from_json(F.col(value), with_corrupt, {"columnNameOfCorruptRecord": corrupt})
    keep = [c for c in df.columns if c != value]
    return (df.withColumn("_v", parsed)
              .select(*keep, *[F.col(f"_v.{f.name}").alias(f.name) for f in schema.fields],
                      F.col(f"_v.{corrupt}").isNotNull().alias("_malformed")))


def audit_lines(records: DataFrame) -> DataFrame:
    """Render consumed records as one text line with key, value, offset, partition."""
    return records.select(
        "offset", "partition",
        audit_line(F.col("key"), F.col("value"), F.col("offset"), F.col("partition")).alias("line"))
