"""Top-k per group and its ranked-list rendering.

``row_number() <= k`` is rewritten by Catalyst into a partial
WindowGroupLimit before the shuffle, so each map task sends at most k rows
per group: a hot group never gathers all of its members in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.functions.text import ranked_list

DEFAULT_K = 5


def top_k(df: DataFrame, group: list[str], order: list[Column], k: int = DEFAULT_K,
          rank: str = "rank") -> DataFrame:
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= F.lit(k))


def top_k_by_volume(volumes: DataFrame, k: int = DEFAULT_K) -> DataFrame:
    """Largest share volumes per industry; ties broken by symbol."""
    return top_k(volumes, ["industry"], [F.desc("shares"), F.asc("symbol")], k)


def render_ranked(top: DataFrame, group: str = "industry", rank: str = "rank",
                  label: str = "symbol", weight: str = "shares") -> DataFrame:
    """One row per group with the ranked list text.  Each list holds at most
    k entries, so the collect is bounded."""
    entries = F.array_sort(F.collect_list(F.struct(F.col(rank), F.col(label), F.col(weight))))
    return (top.groupBy(group).agg(entries.alias("_e"))
               .select(group, ranked_list(F.col("_e"), label, weight).alias("ranking")))
