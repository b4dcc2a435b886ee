"""Text rendering expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's.
AUDIT_LINE = "Consumed: key = %s value = %s with offset = %d partition = %d"


def audit_line(key: Column, value: Column, offset: Column, partition: Column) -> Column:
    return F.format_string(AUDIT_LINE, key, value, offset, partition)


def ranked_list(entries: Column, label: str = "symbol", weight: str = "shares") -> Column:
    """Render an array of structs already in rank order as
    ``1)SYM:1,234 2)SYM:987 `` (grouped digits, each entry followed by a blank)."""
    return F.aggregate(
        F.transform(entries, lambda e, i: F.concat(
            (i + 1).cast("string"), F.lit(")"), e.getField(label), F.lit(":"),
            F.format_number(e.getField(weight), 0), F.lit(" "))),
        F.lit(""), lambda acc, s: F.concat(acc, s))
