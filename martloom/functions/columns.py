"""Column expressions shared by the plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Order status codes and their labels.
ORDER_STATUS = {1: "Pending", 2: "Processing", 3: "Rejected", 4: "Completed"}
COMPLETED = 4

# The text that stands for a missing value in the raw tables, and the
# stock level up to which a product counts as low.
MISSING = "NULL"
LOW_STOCK = 5

# Sales percentiles from which a low stock is of high or medium priority.
HIGH_SELLER = 0.8
MEDIUM_SELLER = 0.5


def hash_pii(value: Column) -> Column:
    """SHA-256 of the text form as lower-case hex; NULL stays NULL."""
    return F.sha2(value.cast("string"), 256)


def surrogate_key(*parts: Column | str) -> Column:
    """A 60-bit key computed from the row's own values, so it needs no shuffle.

    The same row gets the same key in every run. A missing part counts in its place.
    Never NULL, which lets a count of it become a plain row count.
    """
    texts = [(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts]
    shown = [F.coalesce(t, F.lit("\x01")) for t in texts]
    digest = F.md5(F.concat_ws("|", *shown))
    return F.coalesce(
        F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint"), F.lit(0).cast("bigint")
    )


def as_bigint(df: DataFrame, name: str) -> Column:
    """Whole-number cast that rounds fractional input instead of truncating it."""
    column = F.col(name)
    if isinstance(df.schema[name].dataType, T.FractionalType):
        column = F.round(column, 0)
    return column.cast("bigint")


def safe_bigint(value: Column) -> Column:
    return value.try_cast("bigint")


def safe_date(text: Column) -> Column:
    """Year-month-day text as DATE; anything else, the missing marker too, is NULL.

    The pattern is checked because Spark would also accept a bare year or a timestamp.
    """
    text = text.cast("string")
    return F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), text.try_cast("date"))


def decode(code: Column, labels: dict, default: str | None = None) -> Column:
    """Label of a code; unknown codes give ``default``."""
    out = None
    for value, label in labels.items():
        out = F.when(code == value, label) if out is None else out.when(code == value, label)
    return out.otherwise(F.lit(default)) if default is not None else out


def full_name(first: Column, last: Column) -> Column:
    """Both names with a blank between; a missing part counts as empty."""
    return F.concat(F.coalesce(first, F.lit("")), F.lit(" "), F.coalesce(last, F.lit("")))


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier).cast("bigint")


def month_of(day: Column) -> Column:
    """First day of the month, as DATE."""
    return F.trunc(day, "MM")


def year_month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def is_on_time(shipped: Column, delay_days: Column) -> Column:
    """NULL until shipped; then whether the order left by the required date."""
    return F.when(shipped.isNull(), F.lit(None).cast("boolean")).otherwise(
        F.coalesce(delay_days <= 0, F.lit(False))
    )


def stock_status(quantity: Column, healthy: str) -> Column:
    """Stock level as text. An unknown quantity counts as healthy."""
    return (
        F.when(quantity == 0, "Out of stock")
        .when(quantity <= LOW_STOCK, "Low stock")
        .otherwise(healthy)
    )


def restock_priority(quantity: Column, percentile: Column) -> Column:
    low = quantity <= LOW_STOCK
    return (
        F.when(low & (percentile >= HIGH_SELLER), "HIGH")
        .when(low & (percentile >= MEDIUM_SELLER), "MEDIUM")
        .when(low, "LOW")
    )
