"""Event-time expressions.  Driver timestamps are TIMESTAMP_NTZ; arithmetic
on them is done with ``timestampdiff`` so it does not depend on the session
time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_micros(ts: Column | str) -> Column:
    """Microseconds since 1970-01-01 00:00 of a TIMESTAMP_NTZ, computed from
    its date and time-of-day fields, so no session time zone is involved."""
    ts = _c(ts)
    day_us = F.unix_date(F.to_date(ts)).cast("long") * F.lit(86_400_000_000)
    tod_us = ((F.hour(ts) * 3600 + F.minute(ts) * 60).cast("long") * F.lit(1_000_000)
              + (F.extract(F.lit("SECOND"), ts) * F.lit(1_000_000)).cast("long"))
    return day_us + tod_us


def epoch_millis(ts: Column | str) -> Column:
    """Milliseconds since the epoch, truncated (floor) like a millisecond clock."""
    return F.floor(epoch_micros(ts) / F.lit(1000)).cast("long")


def from_epoch_millis(ms: Column | str) -> Column:
    return F.timestamp_add("MILLISECOND", _c(ms), F.expr(_EPOCH))


def trade_event_time(is_trade: Column, trade_ts: Column, record_ts: Column,
                     wall_clock: Column | None = None) -> Column:
    """Event time of a trade record: its own timestamp, else the record's
    timestamp; a record that is not a trade gets the wall clock."""
    wall = wall_clock if wall_clock is not None else F.localtimestamp()
    return F.when(is_trade, F.coalesce(trade_ts, record_ts)).otherwise(wall)


def time_source(is_trade: Column, trade_ts: Column) -> Column:
    return (F.when(~is_trade, F.lit("wall_clock"))
             .when(trade_ts.isNotNull(), F.lit("trade"))
             .otherwise(F.lit("record")))
