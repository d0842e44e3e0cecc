"""Distinct counts that add up from run to run: one small sketch per column and run.

Opt-in: the profile counts exactly.  A sketch of 2**LOG_K registers has a relative standard error of
about 0.8 / sqrt(2**LOG_K), whatever the cardinality, and sketches of several runs or tables merge into that of all
their rows without reading them again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.operators.frequent import cells_of

LOG_K = 14


def distinct_sketches(df: DataFrame, null_tokens: tuple[str, ...] = (), log_k: int = LOG_K) -> DataFrame:
    """(column, sketch) for each column that has a value; one scan, one row a task and column shuffled."""
    return cells_of(df, null_tokens).groupBy("column").agg(F.hll_sketch_agg("value", F.lit(log_k)).alias("sketch"))


def keep(df: DataFrame, path: str, run_id: str, null_tokens: tuple[str, ...] = ()) -> None:
    """Store a run's sketches below ``path``; storing a run again replaces its own only."""
    distinct_sketches(df, null_tokens).coalesce(1).write.mode("overwrite").parquet(f"{path}/run_id={run_id}")


def kept(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("column string, sketch binary, run_id string").parquet(path)


def merged(sketches: DataFrame) -> DataFrame:
    """(column, cardinality): how many distinct values all the runs given have together, about."""
    return sketches.groupBy("column").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("cardinality"))
