"""Co-group two keyed inputs: per key (and flush window) the records of
each side, side by side.

Lists are bounded: records of one (key, window, side) are numbered in time
order and cut into chunks of ``chunk_size``; chunk i of one side is paired
with chunk i of the other.  No key's history is collected into one list, and
no task numbers a hot key's window: records are numbered within time slots,
and a slot goes on from the counts of the slots before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.operators.running import running_aggregate

#: records of a key are numbered by time slots of this length
SLOT = "15 minutes"


def tag_sides(a: DataFrame, b: DataFrame, key: str, ts: str, rid: str) -> DataFrame:
    cols = [F.col(key).alias("key"), F.col(ts).alias("ts"), F.col(rid).alias("rid")]
    return (a.select(*cols, F.lit("a").alias("side"))
             .unionByName(b.select(*cols, F.lit("b").alias("side"))))


def cogroup(a: DataFrame, b: DataFrame, key: str, ts: str, rid: str,
            window: str = "1 day", chunk_size: int = 1000, slot: str = SLOT) -> DataFrame:
    t = tag_sides(a, b, key, ts, rid).withColumn("window_start", F.window("ts", window).start)
    t = t.withColumn("_slot", F.window("ts", slot).start)
    t = running_aggregate(t, ["key", "window_start", "side"], F.col("_slot"), [F.col("ts"), F.col("rid")], F.lit(1), "_at")
    t = t.withColumn("chunk", F.floor((F.col("_at") - 1) / F.lit(chunk_size)).cast("int"))
    side_a, side_b = F.col("side") == "a", F.col("side") == "b"
    return (t.groupBy("key", "window_start", "chunk")
             .agg(F.count_if(side_a).alias("n_a"), F.count_if(side_b).alias("n_b"),
                  F.array_sort(F.collect_list(F.when(side_a, F.col("rid")))).alias("ids_a"),
                  F.array_sort(F.collect_list(F.when(side_b, F.col("rid")))).alias("ids_b")))


def ids_text(col: str):
    return F.array_join(F.transform(F.col(col), lambda x: x.cast("string")), ",")


def render(groups: DataFrame) -> DataFrame:
    """Counts of both sides and their ids as text."""
    return groups.select("key", "window_start", "chunk", F.col("n_a").alias("n_clicks"),
                         F.col("n_b").alias("n_purchases"), ids_text("ids_a").alias("click_ids"),
                         ids_text("ids_b").alias("purchase_ids"))
