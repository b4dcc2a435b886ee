"""Connected components of a graph given as pairs of ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import cut, release


def connected_components(pairs: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, component) for every id in ``pairs`` (a, b); component is the least id that can be reached.

    Alternating large-star and small-star steps: each step joins every id's neighbours to the least of them, so the
    distances shrink fast (a few rounds, about the logarithm of the longest path). A star's rows meet only in partial
    aggregates and in a join that adaptive execution can split; every round is written to shared storage."""
    edges = cut(pairs.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
                "components")
    before = None
    for _ in range(rounds):
        # large star: neighbours that are larger than an id go to the least id of its neighbourhood
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: an id and its smaller neighbours go to the least of these
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        last, edges = edges, cut(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "components")
        release(last)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components have not settled after {rounds} rounds")
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        edges.select("v", "v").distinct())
