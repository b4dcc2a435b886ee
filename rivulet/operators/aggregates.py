"""Keyed reductions and rank pairing.  The reductions are hash aggregates
with a partial (map-side) phase, so a hot key is pre-reduced in every map
task before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.operators.ranks import numbered


def reduce_then_look_up(facts: DataFrame, key: str, totals: list[Column], dim: DataFrame, dim_key: str) -> DataFrame:
    """Reduce facts by ``key`` (in every map task first), then join the one row per key to its dimension row."""
    reduced = facts.groupBy(key).agg(*totals)
    return reduced.join(dim, reduced[key] == dim[dim_key])


def reduce_share_volume(trades: DataFrame) -> DataFrame:
    """Share volume per symbol (binary sum of shares). The key is the symbol alone; the industry is that of the
    symbol's last trade (``ts``, then the larger name)."""
    return (trades.groupBy("symbol")
                  .agg(F.max_by("industry", F.struct("ts", "industry")).alias("industry"),
                       F.sum(F.col("shares").cast("long")).alias("shares")))


def keyed_count(df: DataFrame, keys: list[Column | str], extra: list[Column] | None = None) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *(extra or []))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def pair_by_rank(keys: DataFrame, key: str, items: DataFrame, item_key: str,
                 item_cols: list[str]) -> DataFrame:
    """Pair the n-th smallest key with the n-th smallest ``item_key``.

    Keys and item ids (unique; items without one are left out) are numbered in
    range partitions (``ranks.numbered``) and joined on the number; no task
    holds all of either. The other item columns (e.g. whole texts) are fetched
    for the paired ids only. A key beyond the number of items is kept, with
    null items.
    """
    ids = numbered(items.select(item_key).where(F.col(item_key).isNotNull()), [item_key])
    paired = numbered(keys.select(key), [key]).join(ids, "_n", "left").drop("_n")
    others = [c for c in item_cols if c != item_key]
    return paired.join(items.select(item_key, *others), item_key, "left").select(key, *item_cols)
