"""Mixing sources to target weights over a tree of domains, languages and sources."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from oreflow.llm.common import column, fresh
from oreflow.session import written

MOST_EPOCHS = 4
# A leaf's shuffled order is cut into 16**CELL_DIGITS cells; only the one its quota ends in is gone through by row.
CELL_DIGITS = 3
BLANKS = " \n\r\t"


def words_of(text: Column) -> Column:
    """Words between blanks and line breaks as the measure of tokens; an empty or null text counts as one."""
    return F.size(F.split(F.trim(F.coalesce(text, F.lit("")), F.lit(BLANKS)), f"[{BLANKS}]+")).cast("long")


def shares(children: DataFrame, parent: Sequence[str], name: str) -> DataFrame:
    """Add ``given``: ``budget`` shared among the children of a parent by ``weight``, none above its ``cap``.

    Children are taken in order of cap over weight.  One whose cap lies below its weighted share of what is left
    for it and those after it gets its cap; the first that does not sets the level at which all others share.
    """
    order = Window.partitionBy(*parent).orderBy(F.col("cap") / F.col("weight"), name)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onwards = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everyone = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(onwards)
    return (
        children.withColumn("level", level)
        .withColumn("level", F.when(F.col("cap") / F.col("weight") >= F.col("level"), F.col("level")))
        .withColumn("level", F.first("level", ignorenulls=True).over(everyone))
        .withColumn("given", F.least("cap", F.coalesce(F.col("weight") * F.col("level"), F.col("cap"))))
        .drop("level")
    )


def leaf_quotas(
    supply: DataFrame, levels: Sequence[str], weights: Sequence[Column], budget: float, epochs: int = MOST_EPOCHS
) -> DataFrame:
    """``supply`` (the levels' columns and ``tokens``) with the whole-token ``quota`` of each leaf.

    A leaf gives its tokens at most ``epochs`` times.  The budget goes down the tree: a branch is never given
    more than all below it can use, and what it cannot use goes to its siblings.  So a shortage is made up among
    siblings, and among their parent's siblings only for what the whole branch lacks.  ``weights`` has for each
    level a positive Column over that level's name columns and ``tokens`` (of the whole branch).
    """
    given = None
    for depth, weight in enumerate(weights, 1):
        path = list(levels[:depth])
        branches = supply.groupBy(*path).agg(F.sum("tokens").alias("tokens")).withColumns(
            {"cap": F.col("tokens").cast("double") * epochs, "weight": weight.cast("double")}
        )
        if given is None:
            branches = branches.withColumn("budget", F.lit(float(budget)))
        else:
            branches = branches.join(given, path[:-1])
        given = shares(branches, path[:-1], path[-1]).select(*path, F.col("given").alias("budget"))
    return supply.join(given, list(levels)).withColumn("quota", F.round("budget").cast("long")).drop("budget")


def mix(
    docs: DataFrame,
    levels: Sequence[Column],
    weights: Callable[[Sequence[Column], Column], Sequence[Column]],
    tokens: Column,
    share: float,
    copies: str = "copies",
    epochs: int = MOST_EPOCHS,
    seed: int = 7,
    id_column: str = "doc_id",
) -> DataFrame:
    """All rows and columns of ``docs`` plus ``copies``, how many times the mixture takes the row.

    ``levels`` are the names from the root's children down to the leaf; a null name is a branch of its own.
    ``weights`` gets their columns (a name with "=" before it, or empty for null) and the branch's tokens.  The
    budget is ``share`` of all tokens.  A leaf whose quota is n times its tokens and some more is taken n times
    whole; of epoch n + 1, which has its own seeded order of documents, it takes the prefix that reaches the
    quota, so it goes over it by less than one document.  An empty table gives an empty result; empty texts
    count as ``tokens`` says; rows of one id are taken one by one, next to each other in the order.

    Rows are not shuffled: tokens are summed per leaf and per cell of its order, and only rows of the cell in
    which a quota ends are sorted.
    """
    names = [f"level_{i}" for i in range(len(levels))]
    hidden = fresh(docs, *names, "tokens", "order_key")
    keys, size, place = hidden[: len(names)], hidden[-2], hidden[-1]
    named = docs.withColumns(
        {
            **{k: F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("")) for k, c in zip(keys, levels)},
            size: tokens,
        }
    )
    plain = [F.col(k).alias(n) for k, n in zip(keys, names)]
    supply = written(named.groupBy(*plain).agg(F.sum(size).alias("tokens")))
    budget = (supply.agg(F.sum("tokens")).first()[0] or 0) * share
    quotas = leaf_quotas(supply, names, weights([F.col(n) for n in names], F.col("tokens")), budget, epochs)
    whole, rest, edge, left = fresh(named, "whole", "rest", "edge", "left")
    quotas = written(
        quotas.select(
            *[F.col(n).alias(k) for n, k in zip(names, keys)],
            F.expr("quota DIV tokens").alias(whole),
            (F.col("quota") % F.col("tokens")).alias(rest),
        )
    )
    order = F.md5(
        F.concat_ws(":", F.lit(seed), F.col(whole), F.coalesce(column(id_column).cast("string"), F.lit("null"))).cast("binary")
    )
    ordered = lambda leaves: named.join(leaves, keys).withColumn(place, order)
    cell = F.substring(place, 1, CELL_DIGITS)

    cells = ordered(quotas).groupBy(*keys, rest, cell.alias(edge)).agg(F.sum(size).alias("here"))
    before = F.coalesce(
        F.sum("here").over(Window.partitionBy(*keys).orderBy(edge).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    ends = (
        cells.withColumn("before", before)
        .where((F.col("before") < F.col(rest)) & (F.col(rest) <= F.col("before") + F.col("here")))
        .select(*keys, edge, (F.col(rest) - F.col("before")).alias(left))
    )
    placed = ordered(written(quotas.join(ends, keys, "left")))
    decided = placed.where(F.col(edge).isNull() | (cell != F.col(edge))).withColumn(
        copies, F.col(whole) + F.when(cell < F.col(edge), 1).otherwise(0)
    )
    row_order = Window.partitionBy(*keys).orderBy(place, size)
    passed = F.sum(size).over(row_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col(size)
    last = placed.where(cell == F.col(edge)).withColumn(
        copies, F.col(whole) + F.when(passed < F.col(left), 1).otherwise(0)
    )
    return decided.unionByName(last).drop(*keys, size, place, whole, rest, edge, left)
