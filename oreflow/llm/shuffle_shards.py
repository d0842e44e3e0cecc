"""Uniform shuffle into shards of exact size, by a hypergeometric communication matrix.

Only DataFrame and SQL functions: the matrix is drawn by Column expressions as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from oreflow.llm.common import column, fresh
from oreflow.session import written

# Beyond so many standard deviations from the mode no 53-bit random number can land.
DEVIATIONS = 12
# Rows of a shard that one task permutes at the end, about.
CELL_ROWS = 1_000_000
LEAST_CELLS = 8


def uniform(*key: Column) -> Column:
    """A number in [0, 1) that depends on the key alone, so a task run again draws the same."""
    return F.shiftrightunsigned(F.xxhash64(*key), 11).cast("double") * F.lit(2.0**-53)


def hypergeometric(good: Column, bad: Column, draws: Column, u: Column) -> Column:
    """How many good ones are among ``draws`` taken without return; by inversion outwards from the mode.

    The weight of the mode is set to 1 and those of its neighbours follow from exact ratios, so no
    factorials are needed and nothing is approximated but by rounding of doubles.
    """
    as_double = [c.cast("double").alias(n) for c, n in ((good, "g"), (bad, "b"), (draws, "n"))]
    given = F.struct(*as_double, u.alias("u"))

    def draw(x: Column) -> Column:
        g, b, n = x["g"], x["b"], x["n"]
        all_ = g + b
        low, high = F.greatest(F.lit(0.0), n - b), F.least(g, n)
        mode = F.least(F.greatest(F.floor((n + 1) * (g + 1) / (all_ + 2)).cast("double"), low), high)
        spread = F.sqrt(n * (g / F.greatest(all_, F.lit(1.0))) * (b / F.greatest(all_, F.lit(1.0))))
        reach = F.ceil(spread * DEVIATIONS + 40).cast("double")
        return F.struct(
            g.alias("g"), b.alias("b"), n.alias("n"), x["u"].alias("u"), mode.alias("mode"),
            F.least(reach, high - mode).cast("int").alias("up"),
            F.least(reach, mode - low).cast("int").alias("down"),
        )

    def rise(x: Column, k: Column) -> Column:
        """Weight of k + 1 over that of k."""
        return (x["g"] - k) * (x["n"] - k) / ((k + 1) * (x["b"] - x["n"] + k + 1))

    def steps(count: Column) -> Column:
        return F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))

    def total(x: Column) -> Column:
        def side(count: Column, ratio) -> Column:
            start = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"))

            def add(acc: Column, i: Column) -> Column:
                weight = acc["w"] * ratio(i.cast("double"))
                return F.struct(weight.alias("w"), (acc["sum"] + weight).alias("sum"))

            return F.aggregate(steps(count), start, add, lambda acc: acc["sum"])

        up = side(x["up"], lambda i: rise(x, x["mode"] + i - 1))
        down = side(x["down"], lambda i: F.lit(1.0) / rise(x, x["mode"] - i))
        return x.withField("left", x["u"] * (1.0 + up + down))

    def find(x: Column) -> Column:
        """Walk mode, the values above, those below, until the weights passed exceed ``left``."""
        start = F.struct(
            F.lit(1.0).alias("w"), (x["left"] - 1.0).alias("left"), x["mode"].alias("at"),
            (x["left"] < 1.0).alias("found"),
        )

        def walk(count: Column, first: Column, sign: float, ratio) -> Column:
            def step(acc: Column, i: Column) -> Column:
                i = i.cast("double")
                weight = acc["w"] * ratio(i)
                moved = F.struct(
                    weight.alias("w"), (acc["left"] - weight).alias("left"), (x["mode"] + i * sign).alias("at"),
                    (acc["left"] < weight).alias("found"),
                )
                return F.when(acc["found"], acc).otherwise(moved)

            return F.aggregate(steps(count), first, step)

        above = walk(x["up"], start, 1.0, lambda i: rise(x, x["mode"] + i - 1))
        again = F.when(above["found"], above).otherwise(
            F.struct(F.lit(1.0).alias("w"), above["left"].alias("left"), x["mode"].alias("at"), above["found"].alias("found"))
        )
        below = walk(x["down"], again, -1.0, lambda i: F.lit(1.0) / rise(x, x["mode"] - i))
        return below["at"].cast("long")

    # Each step is evaluated once, on the struct that the step before made.
    made = F.transform(F.array(given), draw)
    made = F.transform(made, total)
    return F.transform(made, find)[0]


def split_counts(pool: Column, draws: Column, *key: Column) -> Column:
    """Take ``draws`` without return from a pool of counts per shard: how many of each shard.

    The first shard against all others, then the second against the rest, and so on.
    """
    start = F.struct(
        draws.cast("long").alias("draws"),
        F.aggregate(pool, F.lit(0).cast("long"), lambda a, c: a + c).alias("rest"),
        F.array().cast("array<bigint>").alias("taken"),
    )

    def take(acc: Column, count: Column) -> Column:
        rest = acc["rest"] - count
        got = hypergeometric(count, rest, acc["draws"], uniform(*key, F.size(acc["taken"])))
        return F.transform(
            F.array(got),
            lambda k: F.struct(
                (acc["draws"] - k).alias("draws"),
                rest.alias("rest"),
                F.concat(acc["taken"], F.array(k)).alias("taken"),
            ),
        )[0]

    return F.aggregate(pool, start, take, lambda acc: acc["taken"])


def communication_matrix(parts: DataFrame, total: int, shards: int, seed: int) -> DataFrame:
    """``parts`` (part int, rows long) with ``until``: per shard the local rank at which its rows end.

    Row sums are the parts' rows, column sums the shards' sizes (at most one apart).  The parts are halved
    again and again as a tree; at each node the left half draws its share of every shard from the node's.
    """
    sizes = [total // shards + (j < total % shards) for j in range(shards)]
    levels = 0
    order = Window.orderBy("part")
    numbered = parts.withColumn("place", F.row_number().over(order) - 1)
    highest = numbered.agg(F.max("place")).first()[0] or 0
    while (1 << levels) <= highest:
        levels += 1
    node = parts.sparkSession.range(1).select(
        F.lit(0).cast("long").alias("node"), F.array(*[F.lit(s).cast("long") for s in sizes]).alias("pool")
    )
    for level in range(levels):
        below = levels - level - 1
        left = (
            numbered.where(F.shiftright("place", below).bitwiseAND(1) == 0)
            .groupBy(F.shiftright("place", below + 1).cast("long").alias("node"))
            .agg(F.sum("rows").alias("rows"))
        )
        taken = split_counts(F.col("pool"), F.col("rows"), F.lit(seed), F.lit(level), F.col("node"))
        # Every node has parts in its left half.
        node = node.join(left, "node").withColumn("left", taken)
        right = F.transform(F.arrays_zip("pool", "left"), lambda x: x["pool"] - x["left"])
        node = node.select(
            F.explode(
                F.array(
                    F.struct((F.col("node") * 2).alias("node"), F.col("left").alias("pool")),
                    F.struct((F.col("node") * 2 + 1).alias("node"), right.alias("pool")),
                )
            ).alias("half")
        ).select("half.*")
        node = node.where(F.col("node") <= (highest >> below))
    ends = F.aggregate(
        "pool",
        F.array().cast("array<bigint>"),
        lambda acc, c: F.concat(acc, F.array(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0).cast("long")) + c)),
    )
    return numbered.join(node.withColumnRenamed("node", "place"), "place").select("part", "rows", ends.alias("until"))


def hypergeometric_shuffle(docs: DataFrame, shards: int = 40, seed: int = 17, cell_rows: int = CELL_ROWS) -> DataFrame:
    """All rows and columns of ``docs`` plus ``shard`` and ``slot`` (gapless from 0 in a shard).

    Every arrangement of the rows is equally likely, and shard sizes differ by one at most.  No column is
    read for it, so nulls, equal rows and empty texts are rows like any other; columns named shard or slot
    are replaced; an empty table gives an empty result.

    Every partition of the input is permuted locally and written with its number and each row's place in it;
    the matrix and the dealing read only these columns, so it does not matter how the copy is cut into tasks
    later.  Rows are dealt out by their part's row of the matrix; those of a shard then go to random cells of
    about ``cell_rows`` rows, which are permuted again and numbered one after the other, so no task holds a
    shard.  A row that the matrix has no place for raises.
    """
    docs = docs.drop("shard", "slot")
    part, key, rank, cell, until = fresh(docs, "part", "key", "rank", "cell", "until")
    place = F.monotonically_increasing_id()
    local_rank = place.bitwiseAND(F.lit((1 << 33) - 1))
    fixed = written(
        docs.withColumns({part: F.spark_partition_id(), key: F.xxhash64(F.lit(seed), place)})
        .sortWithinPartitions(key)
        .withColumn(rank, local_rank)
    )
    parts = written(fixed.groupBy(column(part).alias("part")).agg(F.count(F.lit(1)).alias("rows")))
    total = parts.agg(F.sum("rows")).first()[0] or 0
    if total == 0:
        return fixed.select(*[column(c) for c in docs.columns], F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    matrix = written(communication_matrix(parts, total, shards, seed))

    ends = matrix.select(F.col("part").alias(part), F.col("until").alias(until))
    cells = max(LEAST_CELLS, -(-total // (shards * cell_rows)))
    beyond = F.coalesce(F.col(rank) >= F.element_at(until, -1), F.lit(True))
    dealt = (
        fixed.join(ends, part, "left")
        .withColumn(
            "shard",
            F.when(beyond, F.raise_error(F.lit("the matrix has no place for a row")).cast("int")).otherwise(
                F.size(F.filter(F.col(until), lambda e: e <= F.col(rank)))
            ),
        )
        .withColumn(cell, F.pmod(F.xxhash64(F.lit(seed + 1), F.col(key)), F.lit(cells)))
        .drop(until)
    )
    counts = dealt.groupBy("shard", cell).agg(F.count(F.lit(1)).alias("slot"))
    before = Window.partitionBy("shard").orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", cell, F.coalesce(F.sum("slot").over(before), F.lit(0)).alias(until))
    second = Window.partitionBy("shard", cell).orderBy(F.xxhash64(F.lit(seed + 2), F.col(key)), key)
    return (
        dealt.withColumn("slot", F.row_number().over(second).cast("long") - 1)
        .join(offsets, ["shard", cell])
        .withColumn("slot", F.col("slot") + F.col(until))
        .select(*[column(c) for c in docs.columns], "shard", "slot")
    )
