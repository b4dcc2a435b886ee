"""Purchase record expressions: card masking, patterns, rewards, currency."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's.
CARD_MASK_PREFIX = "xxxx-xxxx-xxxx-"
CARD_MASK_SHORT = "xxxx"
CARD_SEPARATOR = "-"
CURRENCY_RATES = {"EURO": 1.09, "POUNDS": 1.2929, "DOLLARS": 1.0}
INT_MAX = 2147483647
INT_MIN = -2147483648


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def mask_card(card: Column | str) -> Column:
    """Keep the 4th dash-separated group behind a fixed mask.

    Split semantics follow a split that drops trailing empty parts: trailing
    dashes are trimmed first, so ``1-2-3-`` has three parts.  Fewer than four
    parts gives the short mask.  Null stays null.  Parts are counted and cut
    with ``replace``/``substring_index`` (no regex, no array per row).
    """
    card = _c(card)
    body = F.rtrim(card, F.lit(CARD_SEPARATOR))
    n_parts = F.length(body) - F.length(F.replace(body, F.lit(CARD_SEPARATOR), F.lit(""))) + 1
    fourth = F.substring_index(F.substring_index(body, CARD_SEPARATOR, 4), CARD_SEPARATOR, -1)
    return (F.when(card.isNull(), F.lit(None).cast("string"))
             .when(n_parts < 4, F.lit(CARD_MASK_SHORT))
             .otherwise(F.concat(F.lit(CARD_MASK_PREFIX), fourth)))


def amount(price: Column | str = "price", quantity: Column | str = "quantity") -> Column:
    return _c(price) * _c(quantity).cast("double")


def java_int(x: Column | str) -> Column:
    """Narrowing double -> int as a JVM cast does it: truncate toward zero,
    clamp to the int range, NaN -> 0 (Spark's ANSI cast would raise instead)."""
    x = _c(x)
    return (F.when(x.isNull(), F.lit(None).cast("int"))
             .when(F.isnan(x), F.lit(0))
             .when(x >= INT_MAX, F.lit(INT_MAX))
             .when(x <= INT_MIN, F.lit(INT_MIN))
             .otherwise(x.cast("int")))


def null_text(x: Column | str) -> Column:
    """Concatenation renders a missing value as the text ``null``."""
    return F.coalesce(_c(x), F.lit("null"))


def reward_customer(last: Column | str = "last_name", first: Column | str = "first_name") -> Column:
    """Reward key: ``last,first`` (no blank)."""
    return F.concat(null_text(last), F.lit(","), null_text(first))


def client_name(last: Column | str, first: Column | str) -> Column:
    """Client dimension name: ``last, first`` (comma and blank)."""
    return F.concat(null_text(last), F.lit(", "), null_text(first))


def dollar_rate(currency: Column | str) -> Column:
    currency = _c(currency)
    expr = None
    for name, rate in CURRENCY_RATES.items():
        expr = (F.when(currency == name, F.lit(rate)) if expr is None
                else expr.when(currency == name, F.lit(rate)))
    return expr


def to_dollars(amount_col: Column | str, currency: Column | str) -> Column:
    """amount / rate; unknown currency -> null."""
    return _c(amount_col) / dollar_rate(currency)
