"""Column profiling of a text table in two aggregations, whatever its number of columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from oreflow.functions.text import joined
from oreflow.functions.values import to_moment, to_number

# The texts a delimited file uses for "no value".
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
TRUE_FALSE = ("True", "TRUE", "true", "False", "FALSE", "false")

# Distinct values below this share of the rows count as a value set worth listing.
VALUE_SET_SHARE = 0.15
TOP = 3
HIGH_CARDINALITY = "High Cardinality"

# Headings of the report file, in order.
HEADINGS = {
    "name": "Name",
    "column": "Column",
    "max_length": "Max Length",
    "min_length": "Min Length",
    "numeric_max": "Numeric Max",
    "numeric_min": "Numeric Min",
    "null_count": "Null Count",
    "null_pct": "Null Pct",
    "cardinality": "Cardinality",
    "row_count": "Row Count",
    "top_values": "Top 3 Common Values",
    "data_type": "Data Type",
}


def value_counts(df: DataFrame, null_tokens: tuple[str, ...] = NULL_TOKENS) -> DataFrame:
    """Rows (column, value, n): how often each value occurs in each column, NULL included.

    Every column appears, also where the table has no rows.  Cells are counted and shuffled under their column's place, a
    number, which costs less to hash, compare and send than its name.
    """
    texts = F.array(*[F.col(c).cast("string") for c in df.columns])
    cells = df.select(F.posexplode(texts).alias("_place", "value")).withColumn(
        "value", F.when(~F.col("value").isin(*null_tokens), F.col("value"))
    )
    names = F.array(*[F.lit(c) for c in df.columns])
    counted = (
        cells.groupBy("_place", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.element_at(names, F.col("_place") + 1).alias("column"), "value", "n")
    )
    columns = df.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(c) for c in df.columns])).alias("column"),
        F.lit(None).cast("string").alias("value"),
        F.lit(0).cast("bigint").alias("n"),
    )
    return counted.unionAll(columns)


def column_metrics(counts: DataFrame) -> DataFrame:
    """Lengths, numeric range, nulls, cardinality, rows and type label per column."""
    value, n = F.col("value"), F.col("n")
    seen = value.isNotNull()
    judged = counts.select(
        "column",
        "value",
        "n",
        F.length("value").alias("length"),
        to_number(value).alias("number"),
        to_moment(value).isNotNull().alias("is_date"),
    )
    number = F.col("number")
    totals = judged.groupBy("column").agg(
        F.max("length").alias("max_length"),
        F.min("length").alias("min_length"),
        F.max("number").alias("numeric_max"),
        F.min("number").alias("numeric_min"),
        F.sum(F.when(~seen, n).otherwise(0)).alias("null_count"),
        F.count("value").alias("cardinality"),
        F.sum("n").alias("row_count"),
        F.bool_and(F.when(seen, value.isin(*TRUE_FALSE))).alias("_words"),
        F.bool_and(F.when(seen, F.coalesce(number.isin(0.0, 1.0), F.lit(False)))).alias("_bits"),
        F.sum(F.when(number.isNotNull(), n).otherwise(0)).alias("_numeric"),
        F.sum(F.when(F.col("is_date"), n).otherwise(0)).alias("_dates"),
    )
    rows, nulls = F.col("row_count"), F.col("null_count")
    label = (
        F.when(rows == nulls, "Empty")
        .when(F.col("_words") | F.col("_bits"), "Boolean")
        .when(F.col("_numeric") == rows - nulls, "Numeric")
        .when(F.col("_numeric") * 2 >= rows, "Numeric as String")
        .when(F.col("_dates") * 2 > rows, "Date as String")
        .otherwise("String")
    )
    return totals.select(
        "column", "max_length", "min_length", "numeric_max", "numeric_min", "null_count",
        F.try_divide(nulls, rows).alias("null_pct"), "cardinality", "row_count", label.alias("data_type"),
    )


def top_values(counts: DataFrame, k: int = TOP) -> DataFrame:
    """The ``k`` most frequent values per column as ``value(count)``; ties go by value.

    Spark drops all but the first ``k`` rows per column in each task before the shuffle
    (window group limit), so a column of unique values does not end up in one task.  NULL is
    ranked last and dropped afterwards: dropping it first would be pushed below the counting,
    and the table would be read and shuffled again just for this.
    """
    missing = F.col("value").isNull()
    ranking = Window.partitionBy("column").orderBy(missing, F.col("n").desc(), F.col("value"))
    ranked = (
        counts.withColumn("rank", F.row_number().over(ranking))
        .where(F.col("rank") <= k)
        .where(~missing)
    )
    # At most ``k`` rows per column are left to collect.
    shown = F.struct("rank", joined(F.col("value"), F.lit("("), F.col("n"), F.lit(")")).alias("text"))
    return ranked.groupBy("column").agg(
        F.array_join(F.sort_array(F.collect_list(shown))["text"], ", ").alias("top_values")
    )


def profile(df: DataFrame, name: str, null_tokens: tuple[str, ...] = NULL_TOKENS) -> DataFrame:
    """One row per column of ``df`` with everything in ``HEADINGS``."""
    counts = value_counts(df, null_tokens)
    full = column_metrics(counts).join(top_values(counts), "column", "left")
    few = F.col("cardinality") < F.lit(VALUE_SET_SHARE) * F.col("row_count")
    return full.withColumn(
        "top_values", F.when(few, F.coalesce("top_values", F.lit(""))).otherwise(F.lit(HIGH_CARDINALITY))
    ).select(F.lit(name).alias("name"), *[c for c in HEADINGS if c != "name"])


def with_headings(report: DataFrame) -> DataFrame:
    return report.select(*[F.col(c).alias(h) for c, h in HEADINGS.items()])
