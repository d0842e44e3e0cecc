"""Conversions, dates and money as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(10,2)"
OPEN_END = "9999-12-31"

# Fixed pattern: a decimal number, optionally signed and with an exponent.
NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\z"

# Fixed patterns: an ISO day with an optional time, and month/day/year.
ISO_MOMENT = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}([ T][0-9]{1,2}:[0-9]{1,2}(:[0-9]{1,2}([.][0-9]+)?)?)?\z"
US_DATE = r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}\z"


def to_int(c: Column) -> Column:
    return c.try_cast("int")


def to_date(c: Column) -> Column:
    return c.try_cast("date")


def to_money(c: Column) -> Column:
    """Two decimals, half up; NULL where the text is no number or too large."""
    return c.try_cast(MONEY)


def to_number(c: Column) -> Column:
    """Double for text that is a plain number; the pattern keeps out Java forms such as ``1d``."""
    return F.when(F.trim(c).rlike(NUMBER), F.trim(c).try_cast("double"))


def to_moment(c: Column) -> Column:
    """Timestamp for text that looks like one; the patterns keep out bare years, times and numbers."""
    c = F.trim(c)
    return F.when(c.rlike(ISO_MOMENT), c.try_cast("timestamp")).when(
        c.rlike(US_DATE), F.try_to_timestamp(c, F.lit("M/d/yyyy"))
    )


def compact_date(c: Column) -> Column:
    """``yyyymmdd`` text to date; any other length or an impossible day is NULL."""
    iso = F.concat_ws("-", F.left(c, F.lit(4)), F.substring(c, 5, 2), F.substring(c, 7, 2))
    return F.when(F.length(c) == 8, to_date(iso))


def or_open_end(c: Column) -> Column:
    return F.coalesce(c, F.lit(OPEN_END).cast("date"))


def elapsed_ms(start: Column, end: Column) -> Column:
    """Whole milliseconds from ``start`` to ``end``, counted by clock ticks."""
    return F.unix_millis(end.cast("timestamp")) - F.unix_millis(start.cast("timestamp"))


def null_count(*cols: Column) -> Column:
    """How many of the columns are NULL in this row."""
    total = F.lit(0)
    for c in cols:
        total = total + c.isNull().cast("int")
    return total


def fill_sales(sales: Column, quantity: Column, price: Column) -> Column:
    return F.coalesce(sales, price * quantity)


def fill_price(sales: Column, quantity: Column, price: Column) -> Column:
    """Missing price from the *given* sales; a zero quantity gives NULL."""
    return F.coalesce(price, to_money(F.abs(F.try_divide(sales, quantity))))


def reconcile_sales(sales: Column, quantity: Column, price: Column) -> Column:
    """Set sales to price x quantity where they differ, keeping the sign of sales."""
    expected = price * quantity
    return (
        F.when((sales >= 0) & (sales != expected), expected)
        .when((sales < 0) & (F.abs(sales) != expected), -expected)
        .otherwise(sales)
    )


def flag(condition: Column) -> Column:
    """'Y' where true; false and unknown are both 'N'."""
    return F.when(condition, F.lit("Y")).otherwise(F.lit("N"))


def flag_rate(c: Column) -> Column:
    """Share of 'Y' as a fraction with two decimals; NULL over no rows."""
    return F.round(F.avg(F.when(c == "Y", F.lit(1.0)).otherwise(F.lit(0.0))), 2)
