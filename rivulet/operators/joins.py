"""Joins: dimension lookups, and a time-bounded pair join that never
compares all pairs of a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.functions.timecols import epoch_micros


def join_dimension(facts: DataFrame, dim: DataFrame, on: list[str] | str, how: str = "left",
                   order: str | None = None) -> DataFrame:
    """Look up a dimension (a replicated table), which has one row per key: the newest by ``order``, else the largest.
    No job runs while the plan is built, and no side is forced: the planner broadcasts the dimension if its size in
    bytes allows, and AQE may still do so at run time."""
    keys = [on] if isinstance(on, str) else list(on)
    values = [c for c in dim.columns if c not in keys]
    if not values:
        return facts.join(dim.select(*keys).distinct(), keys, how)
    row = F.struct(*values)
    one = dim.groupBy(*keys).agg((F.max_by(row, F.col(order)) if order else F.max(row)).alias("_row"))
    return facts.join(one.select(*keys, "_row.*"), keys, how)


def interval_join(left: DataFrame, right: DataFrame, key: tuple[str, str],
                  ts: tuple[str, str], lower_seconds: int, upper_seconds: int,
                  how: str = "inner", right_id: str | None = None) -> DataFrame:
    """Pairs with equal keys and ``left_ts + lower <= right_ts <= left_ts + upper``.

    Column names of the two sides must not clash.  Time is bucketed by the
    window width W = upper - lower: a left row sits in the bucket of
    ``left_ts + lower``, a right row is copied to its own bucket and the one
    before, and the equi-join runs on (key, bucket).  Each pair is met exactly
    once and a key's rows are only compared within neighbouring buckets.

    ``how``: inner, left, or full.  Full is one outer join: a right row is
    unmatched when both of its bucket copies are, which a count of the
    unmatched copies per ``right_id`` (unique) tells.  On streams (inner or
    left) both sides need watermarks on their time columns; the range in the
    condition bounds the join state.
    """
    lk, rk = key
    lt, rt = ts
    lo, hi = int(lower_seconds * 1_000_000), int(upper_seconds * 1_000_000)
    width = max(hi - lo, 1)
    lb = left.withColumn("_lb", F.floor((_micros(left, lt) + F.lit(lo)) / F.lit(width)))
    rb0 = F.floor(_micros(right, rt) / F.lit(width))
    rb = right.withColumn("_rb", F.explode(F.array(rb0, rb0 - 1)))
    cond = ((F.col(lk) == F.col(rk)) & (F.col("_lb") == F.col("_rb"))
            & (F.col(rt) >= _shift(lt, lo)) & (F.col(rt) <= _shift(lt, hi)))
    if how == "inner":
        return lb.join(rb, cond, "inner").drop("_lb", "_rb")
    if how == "left":
        return lb.join(rb, cond, "left").drop("_lb", "_rb")
    if how != "full":
        raise ValueError("how must be inner, left or full")
    if right_id is None:
        raise ValueError("full interval join needs right_id")
    copies = right.select("*", F.posexplode(F.array(rb0, rb0 - 1)).alias("_copy", "_rb"))
    met = lb.withColumn("_left", F.lit(True)).join(copies, cond, "full")
    lone = F.col("_left").isNull()
    # other rows are spread by what they hold; only the copies of a right row have to meet
    spread = F.when(~lone, F.xxhash64(*left.columns))
    n = F.count(F.lit(1)).over(Window.partitionBy(F.when(lone, F.col(right_id)), spread))
    return (met.withColumn("_n", n).where(~lone | ((F.col("_n") == 2) & (F.col("_copy") == 0)))
            .drop("_lb", "_rb", "_left", "_copy", "_n"))


def interval_join_full_union(left: DataFrame, right: DataFrame, key: tuple[str, str],
                             ts: tuple[str, str], lower_seconds: int, upper_seconds: int) -> DataFrame:
    """Full outer interval join without an anti-join, so it also runs on
    streams: (a) left outer join with the right side copied to two buckets
    gives every pair and the unmatched left rows; (b) right outer join with
    the left side's keys and times (nothing else is kept in its state) copied
    to two buckets gives each right row once, and its unmatched rows are
    added."""
    lk, rk = key
    lt, rt = ts
    lo, hi = int(lower_seconds * 1_000_000), int(upper_seconds * 1_000_000)
    width = max(hi - lo, 1)
    range_cond = (F.col(rt) >= _shift(lt, lo)) & (F.col(rt) <= _shift(lt, hi))
    pairs_and_left = interval_join(left, right, key, ts, lower_seconds, upper_seconds, how="left")
    lb0 = F.floor((_micros(left, lt) + F.lit(lo)) / F.lit(width))
    l2 = left.select(lk, lt, F.explode(F.array(lb0, lb0 + 1)).alias("_lb"))
    r1 = right.withColumn("_rb", F.floor(_micros(right, rt) / F.lit(width)))
    cond = (F.col(lk) == F.col(rk)) & (F.col("_lb") == F.col("_rb")) & range_cond
    right_only = l2.join(r1, cond, "right").where(F.col(lk).isNull()).select(*right.columns)
    return pairs_and_left.unionByName(right_only, allowMissingColumns=True).select(*pairs_and_left.columns)


def _shift(col: str, micros: int) -> Column:
    """``col + INTERVAL`` (the form a stream-stream join reads as a time range)."""
    if micros == 0:
        return F.col(col)
    return F.col(col) + F.expr(f"INTERVAL '{micros / 1_000_000:.6f}' SECOND")


def _micros(df: DataFrame, col: str) -> Column:
    """Epoch microseconds of a TIMESTAMP_NTZ (batch tables) or TIMESTAMP
    (event-time column of a watermarked stream)."""
    from pyspark.sql.types import TimestampType

    if isinstance(df.schema[col].dataType, TimestampType):
        return F.unix_micros(F.col(col))
    return epoch_micros(col)


def pair_purchases(joined: DataFrame, a: dict, b: dict) -> DataFrame:
    """Combine two purchases where either side may be missing: the id comes
    from the first present side, items are the present items, the total adds
    prices with a missing side counted as 0, and both times are kept.

    ``a`` and ``b`` map ``customer``, ``item``, ``price``, ``ts`` to columns.
    """
    return joined.select(
        F.coalesce(F.col(a["customer"]), F.col(b["customer"])).alias("customer_id"),
        F.array_compact(F.array(F.col(a["item"]), F.col(b["item"]))).alias("items_purchased"),
        (F.coalesce(F.col(a["price"]), F.lit(0.0)) + F.coalesce(F.col(b["price"]), F.lit(0.0)))
        .alias("total_amount"),
        F.col(a["ts"]).alias("first_purchase_time"),
        F.col(b["ts"]).alias("second_purchase_time"))
