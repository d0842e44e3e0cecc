"""The most frequent values of every column, exact, without shuffling every distinct value."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from oreflow.session import written

# Candidates per column, values that a task's sketch tracks per column, counters for all other values.
CANDIDATES = 64
TRACKED = 1 << 12
COUNTERS = 1 << 14


def cells_of(df: DataFrame, null_tokens: tuple[str, ...] = ()) -> DataFrame:
    """(column, value) of all values as text, without missing ones."""
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    cells = texts.unpivot([], df.columns, "column", "value").where(F.col("value").isNotNull())
    return cells.where(~F.col("value").isin(*null_tokens)) if null_tokens else cells


def frequent_values(
    df: DataFrame,
    k: int = 3,
    null_tokens: tuple[str, ...] = (),
    candidates: int = CANDIDATES,
    tracked: int = TRACKED,
    counters: int = COUNTERS,
) -> DataFrame:
    """(column, value, n): among its rows each column's ``k`` most frequent values with exact counts, and more.

    First pass: a sketch of ``tracked`` counters per task and column proposes candidates.  Second pass: every
    candidate is counted by itself, all other values share ``counters`` counters by hash.  What is shuffled is
    bounded by tasks times columns times (candidates + counters), whatever the cardinality.

    The counts prove the result.  No value outside the candidates occurs more often than its counter says, so if
    every counter is below the ``k``-th largest candidate, nothing was missed, however good the sketch.  Where a
    counter reaches it (flat columns, or too few candidates), the bound does not suffice: a third pass counts the
    values under exactly those counters by themselves, in full; no column is ever cut or left unproved.
    """
    cells = cells_of(df, null_tokens)
    sketch = F.expr(f"approx_top_k(value, {candidates}, {tracked})")
    proposed = cells.groupBy("column").agg(sketch.alias("found"))
    proposed = written(proposed.select("column", F.explode("found").alias("f")).select("column", F.col("f.item").alias("value")))

    # At most ``candidates`` rows a column.
    known = F.broadcast(proposed.withColumn("known", F.lit(True)))
    slot = F.when(F.col("known").isNull(), F.pmod(F.xxhash64("value"), F.lit(counters)))
    counted = cells.join(known, ["column", "value"], "left").select(
        "column", slot.alias("counter"), F.when(F.col("known"), F.col("value")).alias("value")
    )
    counted = written(counted.groupBy("column", "counter", "value").agg(F.count(F.lit(1)).alias("n")))
    exact = counted.where("counter IS NULL").select("column", "value", "n")

    place = F.row_number().over(Window.partitionBy("column").orderBy(F.desc("n")))
    kth = exact.withColumn("place", place).where(F.col("place") == k).select("column", F.col("n").alias("kth"))
    open_ = counted.where("counter IS NOT NULL").join(kth, "column", "left").where("n >= coalesce(kth, 0)")
    open_ = written(open_.select("column", "counter"))
    if open_.isEmpty():
        return exact
    # At most ``counters`` rows a column.
    rest = (
        cells.join(known, ["column", "value"], "left_anti")
        .withColumn("counter", F.pmod(F.xxhash64("value"), F.lit(counters)))
        .join(F.broadcast(open_), ["column", "counter"], "left_semi")
    )
    return exact.unionByName(rest.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
