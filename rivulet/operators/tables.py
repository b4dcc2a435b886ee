"""Changelog tables: latest value per key by arrival order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: str, seq: str, value_cols: list[str],
                   keep_deletes: bool = False, tombstone: str | None = None) -> DataFrame:
    """Newest record per key by ``seq``; a null ``tombstone`` column marks a
    delete.  Uses ``max_by`` so the reduction is partial (map-side) and never
    gathers a key's history into one task."""
    tomb = tombstone or value_cols[0]
    latest = (df.groupBy(key)
                .agg(F.max_by(F.struct(*value_cols, F.col(seq)), F.col(seq)).alias("_last"))
                .select(key, "_last.*"))
    if keep_deletes:
        return latest
    return latest.where(F.col(tomb).isNotNull())
