"""Slowly changing versions: chaining end dates and looking up the version valid on a day."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType
from pyspark.sql.window import Window

from oreflow.functions.values import or_open_end

# Ids of a key are cut into runs of 2**SLICE_BITS, and the runs into runs again
# until one task can hold what is left: once for 32-bit ids, twice for 64-bit ids.
SLICE_BITS = 21


def chain_end_dates(
    df: DataFrame,
    key: str,
    version_id: str,
    start: str,
    end: str,
    slice_bits: int = SLICE_BITS,
) -> DataFrame:
    """Replace a missing or impossible end (before its start) by the day before the next version.

    The next version is the one with the next larger integer ``version_id`` of the same key,
    whatever its start.  Rows without an id are dropped, a valid end is kept and the last
    version stays open.  Copies of an id all see the same next version, and count as one version that
    starts at the earliest start known among them.

    Copies are collapsed to one point per id first; the points are chained slice by slice, so no task needs
    a whole key, and each row looks its id up.
    """
    rows = df.where(F.col(version_id).isNotNull())
    points = rows.groupBy(F.col(key).alias("_key"), F.col(version_id).cast("long").alias("_id")).agg(
        F.min(start).alias("_start")
    )
    id_bits = 31 if isinstance(df.schema[version_id].dataType, IntegerType) else 63
    following = _next_start(points, slice_bits, levels=math.ceil(id_bits / slice_bits) - 1)
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col(version_id).cast("long") == F.col("_id"))
    unusable = F.col(end).isNull() | (F.col(start) > F.col(end))
    return (
        rows.join(following, same)
        .withColumn(end, F.when(unusable, F.date_sub("_next", 1)).otherwise(F.col(end)))
        .select(*df.columns)
    )


def _next_start(points: DataFrame, slice_bits: int, levels: int) -> DataFrame:
    """Add ``_next``, the start of the next larger id of the key, with no task seeing a whole key.

    Within a slice of ids a window finds it; the last point of a slice takes the first point of
    the next slice, which is the same question one level up on far fewer rows.
    """
    if levels == 0:
        by_id = Window.partitionBy("_key").orderBy("_id")
        return points.withColumn("_next", F.lead("_start").over(by_id))
    sliced = points.withColumn("_slice", F.shiftright("_id", slice_bits))
    heads = sliced.groupBy("_key", "_slice").agg(
        F.min(F.struct("_id", "_start")).alias("_head")
    )
    heads = heads.select("_key", F.col("_slice").alias("_id"), F.col("_head")["_start"].alias("_start"))
    heads = _next_start(heads, slice_bits, levels - 1).select(
        F.col("_key").alias("_head_key"), F.col("_id").alias("_head_slice"), F.col("_next").alias("_after")
    )
    in_slice = Window.partitionBy("_key", "_slice").orderBy("_id")
    return (
        sliced.withColumn("_inner", F.lead(F.struct("_start")).over(in_slice))
        .join(heads, F.col("_key").eqNullSafe(F.col("_head_key")) & (F.col("_slice") == F.col("_head_slice")))
        .withColumn(
            "_next", F.when(F.col("_inner").isNotNull(), F.col("_inner")["_start"]).otherwise(F.col("_after"))
        )
        .select("_key", "_id", "_start", "_next")
    )


def version_join(
    facts: DataFrame,
    versions: DataFrame,
    fact_key: str,
    on_date: str,
    version_key: str,
    start: str,
    end: str,
    take: list[str],
) -> DataFrame:
    """Left join each fact with the versions of its key valid on its date (both ends included).

    Every key's days are cut into cells as wide as its versions last on average, up to the start of its
    last version, after which nothing changes but ends.  A version is listed under each cell it touches,
    so a key has at most three listings a version however its versions overlap, and a fact meets only those of
    its own cell.  Facts are read once; both joins are equi-joins, which Spark broadcasts where the
    versions are small and in which AQE splits a hot key where not.
    """
    fact_columns = [F.col(c) for c in facts.columns]
    taken = [F.col(c) for c in take]
    ranges = versions.select(
        F.col(version_key).alias("_key"), F.col(start).alias("_from"), or_open_end(F.col(end)).alias("_to"), *take
    ).where("_key IS NOT NULL AND _from <= _to")
    lasts = ranges.groupBy(F.col("_key").alias("_grid_key")).agg(F.max("_from").alias("_last"))
    on_grid = F.col("_key") == F.col("_grid_key")
    days = F.datediff(F.least("_to", "_last"), "_from") + 1
    grid = ranges.join(lasts, on_grid).groupBy("_grid_key", "_last").agg(F.ceil(F.avg(days)).cast("int").alias("_width"))

    listed = ranges.join(grid, on_grid).select(
        "_key", "_from", "_to", *taken, F.explode(F.sequence(_cell(F.col("_from")), _cell(F.col("_to")))).alias("_cell")
    )
    # Null-safe, though no grid has a NULL key: the grid then gets an exchange of its own instead of keeping that
    # of its aggregate, without which AQE can't split a hot key of the facts.
    placed = facts.join(grid, F.col(fact_key).eqNullSafe(F.col("_grid_key")), "left").withColumn(
        "_fact_cell", _cell(F.col(on_date))
    )
    same_cell = (F.col(fact_key) == F.col("_key")) & (F.col("_fact_cell") == F.col("_cell"))
    valid = F.col(on_date).between(F.col("_from"), F.col("_to"))
    return placed.join(listed, same_cell & valid, "left").select(*fact_columns, *taken)


def _cell(day: Column) -> Column:
    """The cell of a day on its key's grid; NULL for a NULL day, which ``least`` alone would skip."""
    cell = F.floor(F.unix_date(F.least(day, F.col("_last"))) / F.col("_width")).cast("int")
    return F.when(day.isNotNull(), cell)
