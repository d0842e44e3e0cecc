"""Text rules as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CR = "\r"


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def strip_cr(c: Column) -> Column:
    """Drop carriage returns at both ends, nothing else."""
    return F.btrim(c, F.lit(CR))


def clean(c: Column) -> Column:
    """Trim spaces (not tabs); blank becomes NULL."""
    return blank_to_null(F.trim(c))


def clean_last_field(c: Column) -> Column:
    """``clean`` for the last field of a CRLF file: the CR sits outside the spaces or inside them."""
    return blank_to_null(F.trim(strip_cr(F.trim(c))))


def clip(c: Column, width: int) -> Column:
    """Cut to a declared width. ``cast(varchar(n))`` would not."""
    return F.left(c, F.lit(width))


def sentence_case(c: Column) -> Column:
    """First letter upper, all others lower; unlike ``initcap`` later words stay lower."""
    return F.concat(F.upper(F.left(c, F.lit(1))), F.lower(F.substring(c, 2, 2**31 - 1)))


def tail(c: Column, start: int) -> Column:
    """Everything from the 1-based position ``start``."""
    return F.substring(c, start, 2**31 - 1)


def from_first(c: Column, needle: str) -> Column:
    """The text from the first ``needle`` on; NULL where it does not occur."""
    return F.when(F.instr(c, needle) > 0, c.substr(F.instr(c, needle), F.length(c)))


def without_prefix(c: Column, prefix: str) -> Column:
    return F.when(c.startswith(prefix), tail(c, len(prefix) + 1)).otherwise(c)


def joined(*parts: Column) -> Column:
    """Concatenate, reading NULL as empty text."""
    return F.concat(*[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
