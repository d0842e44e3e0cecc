"""Exact top-k inner products by vector-approximation files."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType
from pyspark.sql.window import Window

from oreflow.llm.common import as_batch, column
from oreflow.session import written

BLOCK = 4096
QUERY_BLOCK = 512
CELLS = 256
# Blocks of cells that one copy of a block of queries meets.
SITE_BLOCKS = 8
# Above this a sum of products might not be exact in a double.
EXACT = 2.0**53

_QUERIES = pa.schema([("query_block", pa.int64()), ("dim", pa.int32()), ("query_ids", pa.binary()), ("queries", pa.binary())])
_QUERIES_DDL = "query_block bigint, dim int, query_ids binary, queries binary"
_CELLS = pa.schema(
    [
        ("block", pa.int64()),
        ("dim", pa.int32()),
        ("classes", pa.binary()),
        ("owners", pa.binary()),
        ("owned", pa.binary()),
        ("low", pa.binary()),
        ("step", pa.binary()),
        ("cells", pa.binary()),
    ]
)
_CELLS_DDL = (
    "block bigint, dim int, classes binary, owners binary, owned binary, low binary, step binary, cells binary"
)


def _to_cells(exact: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per dimension 256 cells of equal width over the block's range: low end, width, cell numbers."""
    low, high = exact.min(axis=0), exact.max(axis=0)
    step = np.maximum((high - low) / CELLS, np.finfo(np.float64).tiny)
    cells = np.clip(np.floor((exact - low) / step), 0, CELLS - 1).astype(np.uint8)
    return low, step, cells


def _whole(vectors: Iterator[list[float]]) -> np.ndarray:
    return np.floor(256.0 * np.array(list(vectors), np.float64))


def _blocks(size: int, make):
    """Cut rows (.., vector, part) into blocks of vectors of one length; ``make`` turns (number, rows) into a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[tuple]] = {}
        part = made = 0
        for batch in batches:
            for *row, vector, part in zip(*(c.to_pylist() for c in batch.columns)):
                rows = waiting.setdefault(len(vector), [])
                rows.append((*row, vector))
                if len(rows) == size:
                    made += 1
                    yield make((part << 33) + made, waiting.pop(len(vector)))
        for rows in waiting.values():
            made += 1
            yield make((part << 33) + made, rows)

    return run


def _query_block(number: int, rows: list[tuple[int, list[float]]]) -> pa.RecordBatch:
    exact = _whole(v for _, v in rows)
    ids = np.array([i for i, _ in rows], np.int64)
    values = [[number], [exact.shape[1]], [ids.tobytes()], [exact.tobytes()]]
    return as_batch(_QUERIES, dict(zip(_QUERIES.names, values)))


def _cell_block(number: int, rows: list[tuple[int, int | None, list[float]]]) -> pa.RecordBatch:
    low, step, cells = _to_cells(_whole(v for *_, v in rows))
    classes = np.array([c for c, _, _ in rows], np.int64)
    owned = np.array([o is not None for _, o, _ in rows])
    owners = np.array([o or 0 for _, o, _ in rows], np.int64)
    arrays = [classes, owners, owned, low, step, cells]
    values = [[number], [cells.shape[1]], *[[a.tobytes()] for a in arrays]]
    return as_batch(_CELLS, dict(zip(_CELLS.names, values)))


class _Approximation:
    """A block's cells, and bounds of inner products from them."""

    def __init__(self, row: dict):
        self.classes = np.frombuffer(row["classes"], np.int64)
        self.owners = np.frombuffer(row["owners"], np.int64)
        self.owned = np.frombuffer(row["owned"], np.bool_)
        shape = (len(self.classes), row["dim"])
        low, step = np.frombuffer(row["low"]), np.frombuffer(row["step"])
        cells = np.frombuffer(row["cells"], np.uint8).reshape(shape)
        # Widened by a little, so that rounding here cannot make a bound too tight.
        slack = np.abs(low) * 1e-12 + step * 1e-6
        self.floor = low + cells * step - slack
        self.ceil = low + (cells + 1.0) * step + slack

    def lowest(self, queries: np.ndarray) -> np.ndarray:
        return np.maximum(queries, 0) @ self.floor.T + np.minimum(queries, 0) @ self.ceil.T

    def highest(self, queries: np.ndarray) -> np.ndarray:
        return np.maximum(queries, 0) @ self.ceil.T + np.minimum(queries, 0) @ self.floor.T

    def only_itself(self, query_ids: np.ndarray) -> np.ndarray:
        """Where a class has no row but the query's own."""
        return (query_ids[:, None] == self.owners[None, :]) & self.owned[None, :]


def _queries_of(row: dict) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row["query_ids"], np.int64)
    return ids, np.frombuffer(row["queries"]).reshape(len(ids), row["dim"])


_SURE = pa.schema([("query_block", pa.int64()), ("query", pa.int32()), ("sure", pa.float64())])
_SURE_DDL = "query_block bigint, query int, sure double"


def _sure(k: int):
    """Per query the k best lower bounds of a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                near = _Approximation(row)
                query_ids, queries = _queries_of(row)
                low = near.lowest(queries)
                low[near.only_itself(query_ids)] = -np.inf
                low = -np.partition(-low, min(k, low.shape[1]) - 1, axis=1)[:, :k]
                query, place = np.nonzero(np.isfinite(low))
                yield as_batch(
                    _SURE,
                    {
                        "query_block": np.full(len(query), row["query_block"]),
                        "query": query.astype(np.int32),
                        "sure": low[query, place],
                    },
                )

    return run


_OPEN = pa.schema([("query_id", pa.int64()), ("class", pa.int64()), ("bound", pa.float64())])
_OPEN_DDL = "query_id bigint, class bigint, bound double"


def _open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The classes of a block whose upper bound reaches what the query's kth score cannot fall below."""
    for batch in batches:
        for row in batch.to_pylist():
            near = _Approximation(row)
            query_ids, queries = _queries_of(row)
            sure = np.full(len(query_ids), -np.inf)
            for s in row["sure"] or []:
                sure[s["query"]] = s["sure"]
            high = near.highest(queries)
            query, place = np.nonzero((high >= sure[:, None]) & ~near.only_itself(query_ids))
            yield as_batch(
                _OPEN, {"query_id": query_ids[query], "class": near.classes[place], "bound": high[query, place]}
            )


def products(query: np.ndarray, vectors: np.ndarray) -> list[int]:
    """Inner products of whole numbers held as doubles, exact at any size."""
    largest = np.abs(query).max(initial=0) * np.abs(vectors).max(initial=0) * len(query)
    if largest < EXACT:
        return (vectors @ query).astype(np.int64).tolist()
    whole = [int(x) for x in query]
    return [sum(a * int(b) for a, b in zip(whole, v)) for v in vectors]


@F.arrow_udf(LongType())
def _score(asked: pa.Array, vector: pa.Array) -> pa.Array:
    return pa.array([products(_whole([q.as_py()])[0], _whole([v.as_py()]))[0] for q, v in zip(asked, vector)], pa.int64())


def _classes(rows: DataFrame, k: int) -> DataFrame:
    """One row per distinct vector: class, vector, members (its k + 1 smallest ids, each with its number of rows,
    which are enough whichever id a query leaves out), owner (the id, if there is one only)."""
    counted = rows.groupBy("vector", "vec_id").agg(F.count(F.lit(1)).alias("rows"))
    by_id = Window.partitionBy("vector").orderBy("vec_id")
    first = counted.withColumn("place", F.row_number().over(by_id)).where(F.col("place") <= k + 1)
    member = F.struct("vec_id", F.least("rows", F.lit(k)).alias("rows"))
    classes = first.groupBy("vector").agg(F.array_sort(F.collect_list(member)).alias("members"))
    owner = F.when(F.size("members") == 1, F.col("members")[0]["vec_id"])
    return written(classes.select(F.monotonically_increasing_id().alias("class"), owner.alias("owner"), "vector", "members"))


def open_classes(asked: DataFrame, classes: DataFrame, k: int, block: int, query_block: int) -> DataFrame:
    """The scan of the cells: (query_id, class, bound) for every class that may be among a query's k best."""
    part = F.spark_partition_id().alias("part")
    blocks = written(
        classes.select("class", "owner", "vector", part).mapInArrow(_blocks(block, _cell_block), _CELLS_DDL)
    )
    queries = written(asked.select("vec_id", "vector", part).mapInArrow(_blocks(query_block, _query_block), _QUERIES_DDL))
    # Every block of queries goes to every site of its length, and meets the blocks of cells there.
    sites = blocks.count() // SITE_BLOCKS + 1
    sited = blocks.withColumn("site", F.pmod(F.xxhash64("block"), F.lit(sites)).cast("int"))
    sent = queries.withColumn("site", F.explode(F.sequence(F.lit(0), F.lit(sites - 1))))
    best = Window.partitionBy("query_block", "query").orderBy(F.desc("sure"))
    sure = (
        sent.join(sited, ["dim", "site"])
        .mapInArrow(_sure(k), _SURE_DDL)
        .withColumn("place", F.row_number().over(best))
        .where(F.col("place") <= k)
        .groupBy("query_block", "query")
        .agg(F.min("sure").alias("sure"), F.count(F.lit(1)).alias("places"))
        .where(F.col("places") == k)
        .groupBy("query_block")
        .agg(F.collect_list(F.struct("query", "sure")).alias("sure"))
    )
    return written(
        sent.join(written(sure), "query_block", "left").join(sited, ["dim", "site"]).mapInArrow(_open, _OPEN_DDL)
    )


def top_products(
    vectors: DataFrame,
    k: int = 5,
    every: int = 50,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    block: int = BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """Each query's k highest integer inner products: query_id, rank from 1, vec_id, score.

    A component x counts as floor(256 * x).  Queries are the rows whose id is divisible by ``every``; all rows
    but those with the query's own id are candidates, fewer than k give fewer results, and ties go to the
    smaller id.  Rows with a null id, or a vector that is null, empty or holds a null or non-finite component,
    take no part; vectors of another length are not compared.  Rows that repeat an id are candidates of their
    own and, if divisible, one query: the first by its components.  Scores beyond 64 bits raise.

    Rows with equal vectors are one class, however many they are.  Blocks of classes hold one byte per component
    (the cell); a scan of them gives every query a bound that its kth score cannot fall below, a second one the
    classes whose upper bound reaches it.  Only these classes' exact vectors are read, best bound first: the k
    with the highest bounds, whose scores raise the bound on the kth, then those that still reach it.  After
    that the kth is certain, as no bound that was left reaches its score.
    Queries meet cells block by block, so no task holds more than one block of each.
    """
    rows = vectors.select(
        column(id_column).cast("long").alias("vec_id"), column(vector_column).cast("array<double>").alias("vector")
    )
    finite = F.forall(F.col("vector"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where(F.col("vec_id").isNotNull() & (F.size("vector") > 0) & finite)
    classes = _classes(rows, k)
    asked = written(rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("vector").alias("vector")))
    scan = open_classes(asked, classes, k, block, query_block)

    def read(wanted: DataFrame) -> DataFrame:
        named = asked.select(F.col("vec_id").alias("query_id"), F.col("vector").alias("asked"))
        exact = wanted.join(classes.drop("owner"), "class").join(named, "query_id")
        return exact.select("query_id", "class", "bound", "members", _score("asked", "vector").alias("score"))

    by_bound = Window.partitionBy("query_id").orderBy(F.desc("bound"), "class")
    ahead = scan.withColumn("place", F.row_number().over(by_bound)).where(F.col("place") <= k).drop("place")
    first = written(read(ahead))
    place = F.struct(-F.col("bound"), F.col("class"))
    reached = first.groupBy("query_id").agg(
        F.max(place).alias("edge"), F.when(F.count(F.lit(1)) == k, F.min("score")).cast("double").alias("kth")
    )
    left = scan.join(reached, "query_id").where((place > F.col("edge")) & (F.col("bound") >= F.col("kth")))
    scored = first.unionByName(read(left.select("query_id", "class", "bound")))
    hits = (
        scored.select("query_id", "score", F.inline("members"))
        .where("vec_id <> query_id")
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    )
    # The limit on the rank lets each task keep k per query before they are shuffled.
    best_first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
