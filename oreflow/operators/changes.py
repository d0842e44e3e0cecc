"""What differs between two states of a table, by order-free fingerprints of its rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.session import written

ADDED, REMOVED, CHANGED = "ADDED", "REMOVED", "CHANGED"

# A node of the tree has 2**FAN_BITS children.  A leaf holds about LEAF_ROWS rows.
FAN_BITS = 4
LEAF_ROWS = 1 << 14
MOST_LEVELS = 8

_SUMS = ["f0", "f1", "f2", "f3"]
_HALF = 1 << 32


def row_hashes(columns: list[str]) -> list[Column]:
    """Two 64-bit hashes of a row as four halves; NULL differs from any value and from its place left out."""
    parts = [*columns, *[F.col(c).isNull() for c in columns]]
    hashes = [F.xxhash64(F.lit(seed), *parts) for seed in (0, 1)]
    return [half for h in hashes for half in (h.bitwiseAND(F.lit(_HALF - 1)), F.shiftrightunsigned(h, 32))]


def _added_up(values: list[Column]) -> list[Column]:
    """Sums modulo 2**32: those of disjoint sets of rows add up to that of their union, whatever the order."""
    return [F.pmod(F.sum(v), F.lit(_HALF)).alias(name) for v, name in zip(values, _SUMS)]


def fingerprints(df: DataFrame, key: Column, columns: list[str] | None = None) -> DataFrame:
    """(key, rows, f0..f3): number and multiset fingerprint of the rows of each key, NULL being one.

    Equal multisets have equal fingerprints; different ones of a key agree by chance in one of 2**128 cases.  Sums
    of halves leave room for 2**31 rows a key.  Aggregated before the shuffle: a hot key is one row per task.
    """
    return df.groupBy(key.alias("key")).agg(
        F.count(F.lit(1)).alias("rows"), *_added_up(row_hashes(columns or df.columns))
    )


def key_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """(key, change) for the keys whose fingerprints differ; both sides meet in one aggregation."""
    state = F.struct("rows", *_SUMS)
    both = before.select("key", state.alias("before"), F.lit(None).cast(_state_type()).alias("after")).unionByName(
        after.select("key", F.lit(None).cast(_state_type()).alias("before"), state.alias("after"))
    )
    met = both.groupBy("key").agg(F.max("before").alias("before"), F.max("after").alias("after"))
    change = F.when(F.col("before").isNull(), ADDED).when(F.col("after").isNull(), REMOVED).otherwise(CHANGED)
    return met.where(~F.col("before").eqNullSafe(F.col("after"))).select("key", change.alias("change"))


def _state_type() -> str:
    return f"struct<rows:bigint,{','.join(f'{s}:bigint' for s in _SUMS)}>"


# -- the hash tree -------------------------------------------------------------------------------


def levels_for(rows: int, leaf_rows: int = LEAF_ROWS) -> int:
    """Levels below the root that make leaves of about ``leaf_rows`` rows."""
    levels = 0
    while (rows >> (FAN_BITS * levels)) > leaf_rows and levels < MOST_LEVELS:
        levels += 1
    return levels


def leaf_of(columns: list[str], levels: int) -> Column:
    """The leaf of a row, by a hash of its own: equal rows share one, and no key is hotter than its copies."""
    hashed = F.xxhash64(F.lit(2), *columns, *[F.col(c).isNull() for c in columns])
    return F.shiftrightunsigned(hashed, 64 - FAN_BITS * levels) if levels else F.lit(0).cast("long")


def leaves(df: DataFrame, columns: list[str], levels: int) -> DataFrame:
    """(node, rows, f0..f3) per leaf: all that one side has to send the other to be compared with it."""
    return df.groupBy(leaf_of(columns, levels).alias("node")).agg(
        F.count(F.lit(1)).alias("rows"), *_added_up(row_hashes(columns))
    )


def _parents(nodes: DataFrame) -> DataFrame:
    summed = [F.sum("rows").alias("rows"), *_added_up([F.col(s) for s in _SUMS])]
    return nodes.groupBy(F.shiftrightunsigned("node", FAN_BITS).alias("node")).agg(*summed)


def differing_leaves(left: DataFrame, right: DataFrame, levels: int) -> DataFrame:
    """(node) of the leaves in which two sides differ, found from the root down.

    A node is looked at only if its parent differs, so where sides agree nothing below their common root is
    compared.  Higher levels are added up from the leaves; none of this reads the tables.
    """
    sides = [[left], [right]]
    for trees in sides:
        for _ in range(levels):
            trees.append(written(_parents(trees[-1])))
    # Up to here from the leaves; from here on from the root.
    open_ = left.sparkSession.range(1).select(F.col("id").alias("node"))
    for a, b in zip(reversed(sides[0]), reversed(sides[1])):
        here = [side.join(open_, "node", "left_semi") for side in (a, b)]
        differing = written(key_changes(*[h.withColumnRenamed("node", "key") for h in here]).select(F.col("key").alias("node")))
        if a is left or differing.isEmpty():
            return differing
        first = F.col("node") * (1 << FAN_BITS)
        open_ = differing.select(F.explode(F.sequence(first, first + ((1 << FAN_BITS) - 1))).alias("node"))
    raise AssertionError("the leaves are the last level")


def content_differences(left: DataFrame, right: DataFrame, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """The rows that two tables hold unequally often, with how often: left_rows, right_rows.

    Columns go by name and both sides need the same; NULLs equal each other.  Each side is read once for the
    fingerprints of its leaves.  If those differ anywhere, it is read again, but only rows of differing leaves are
    shuffled and counted, by whole rows: what is reported is exact.  Equal tables need no shuffle of rows at all.
    """
    columns = left.columns
    if sorted(columns) != sorted(right.columns):
        raise ValueError(f"columns {sorted(columns)} and {sorted(right.columns)} differ")
    right = right.select(*columns)
    rows = max(left.count(), right.count())
    levels = levels_for(rows, leaf_rows)
    trees = [written(leaves(side, columns, levels)) for side in (left, right)]
    nodes = differing_leaves(*trees, levels)
    counts = [F.lit(1).cast("long"), F.lit(0).cast("long")]

    def in_question(side: DataFrame) -> DataFrame:
        """The rows of differing leaves; a table of one leaf is compared whole."""
        if not levels:
            return side
        wanted = nodes.withColumnRenamed("node", "_leaf")
        return side.withColumn("_leaf", leaf_of(columns, levels)).join(wanted, "_leaf", "left_semi")

    held = [
        in_question(side).select(*columns, here.alias("left_rows"), there.alias("right_rows"))
        for side, here, there in ((left, *counts), (right, *reversed(counts)))
    ]
    counted = reduce(DataFrame.unionAll, held).groupBy(*columns).agg(
        F.sum("left_rows").alias("left_rows"), F.sum("right_rows").alias("right_rows")
    )
    return counted.where("left_rows <> right_rows")
