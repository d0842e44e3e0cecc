"""Comparing two sides: row counts per table and sets of keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ONLY_LEFT, ONLY_RIGHT, COUNT_MISMATCH, MATCH = "ONLY_LEFT", "ONLY_RIGHT", "COUNT_MISMATCH", "MATCH"


def reconcile(left: DataFrame, right: DataFrame, keys: list[str], left_rows=None, right_rows=None) -> DataFrame:
    """Rows per key on either side and how they compare; NULL keys match each other.

    Both sides are counted in one aggregation of their union, so there is one shuffle, combined
    on the map side, where a full outer join would shuffle every row of both.
    ``left_rows``/``right_rows`` are the row weights: 1 by default, or a count column.
    """
    nothing = F.lit(None).cast("bigint")
    weight = [F.lit(1) if w is None else w for w in (left_rows, right_rows)]
    both = left.select(*keys, weight[0].cast("bigint").alias("_l"), nothing.alias("_r")).union(
        right.select(*keys, nothing.alias("_l"), weight[1].cast("bigint").alias("_r"))
    )
    counts = both.groupBy(*keys).agg(F.sum("_l").alias("left_rows"), F.sum("_r").alias("right_rows"))
    return counts.withColumn(
        "outcome",
        F.when(F.col("right_rows").isNull(), F.lit(ONLY_LEFT))
        .when(F.col("left_rows").isNull(), F.lit(ONLY_RIGHT))
        .when(F.col("left_rows") != F.col("right_rows"), F.lit(COUNT_MISMATCH))
        .otherwise(F.lit(MATCH)),
    )


def key_set_difference(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """The keys found on one side only; the sets are equal when this is empty."""
    return (
        reconcile(left, right, keys)
        .where(F.col("outcome").isin(ONLY_LEFT, ONLY_RIGHT))
        .select(*keys, "outcome")
    )


def row_count(df: DataFrame, name: str) -> DataFrame:
    """One row (table, rows)."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")


def reconcile_tables(left: dict[str, DataFrame], right: dict[str, DataFrame]) -> DataFrame:
    """Row counts of same-named tables on both sides."""

    def counts(tables: dict[str, DataFrame]) -> DataFrame:
        frames = [row_count(df, name) for name, df in tables.items()]
        out = frames[0]
        for frame in frames[1:]:
            out = out.union(frame)
        return out

    return reconcile(counts(left), counts(right), ["table"], F.col("rows"), F.col("rows"))
