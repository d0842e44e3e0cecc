"""Filling a gap from sibling rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fill_from_siblings(df: DataFrame, group: str, column: str, into: str) -> DataFrame:
    """Add ``into``: the row's own value, or where it is NULL the largest one in its group; NULL groups form one.

    Only rows without a value meet the groups' answers, in a join whose hot keys AQE splits; the others go through
    without a shuffle.  ``df`` is evaluated three times, once with these two columns only.
    """
    has_value = F.col(column).isNotNull()
    answers = df.where(has_value).groupBy(F.col(group).alias("_lender")).agg(F.max(column).alias("_lent"))
    lacking = df.where(~has_value).join(answers, F.col(group).eqNullSafe(F.col("_lender")), "left")
    columns = [F.col(c) for c in df.columns]
    return df.where(has_value).select(*columns, F.col(column).alias(into)).unionAll(
        lacking.select(*columns, F.col("_lent").alias(into))
    )
