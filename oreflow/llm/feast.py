"""Eigenvectors of a covariance by contour integration, and embeddings whitened along them."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.llm.common import as_batch, column
from oreflow.session import written

COMPONENTS = 32
SCALE, SHIFT = 64.0, 1_000_000
# A covariance of so many dimensions (33 MB) is the largest that is given to tasks; more raise.
MOST_DIMENSIONS = 2048
# Entries beyond this would not be exact in a double.
LARGEST = 2.0**52
# Eigenvalues an interval may hold, nodes on its half circle, refinements of its subspace.
IN_INTERVAL = 6
NODES = 16
MOST_ROUNDS = 40
# Eigenvalues so many radii from an interval's centre are all but gone after one projection.
NEAR = 1.6
# Shifts tried when an interval is cut.
SHIFTS = 129


# -- the eigenproblem: one bounded matrix --------------------------------------------------------


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a similar tridiagonal matrix, by Householder reflections."""
    a = np.array(matrix, np.float64)
    for k in range(len(a) - 2):
        x = a[k + 1 :, k]
        norm = np.linalg.norm(x)
        if norm == 0.0:
            continue
        v = x.copy()
        v[0] += np.copysign(norm, v[0])
        v /= np.linalg.norm(v)
        a[k + 1 :, k:] -= 2.0 * np.outer(v, v @ a[k + 1 :, k:])
        a[k:, k + 1 :] -= 2.0 * np.outer(a[k:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, -1).copy()


def above(diagonal: np.ndarray, off: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """Inertia: how many eigenvalues exceed each shift, by the signs of the pivots of T - shift."""
    shifts = np.atleast_1d(np.asarray(shifts, np.float64))
    least = np.finfo(np.float64).tiny * max(1.0, float(np.max(off**2, initial=0.0)))
    pivot = diagonal[0] - shifts
    count = np.zeros(len(shifts), np.int64)
    for i in range(len(diagonal)):
        if i:
            pivot = diagonal[i] - shifts - off[i - 1] ** 2 / pivot
        pivot = np.where(np.abs(pivot) < least, -least, pivot)
        count += pivot > 0
    return count


@dataclass(frozen=True)
class Interval:
    """Eigenvalues in (low, high], ``count`` of them by inertia; ``rank`` larger ones, ``near`` within NEAR radii."""

    low: float
    high: float
    count: int
    rank: int
    near: int = 0


def _cut(diagonal: np.ndarray, off: np.ndarray, low: float, high: float) -> float:
    """A point in the middle of the widest gap that the shifts show, away from either end."""
    shifts = np.linspace(low, high, SHIFTS)
    counts = above(diagonal, off, shifts)
    inner = counts[(counts < counts[0]) & (counts > counts[-1])]
    if not len(inner):
        return (low + high) / 2
    widest = max(set(inner.tolist()), key=lambda c: (counts == c).sum())
    return float(shifts[counts == widest].mean())


def intervals(diagonal: np.ndarray, off: np.ndarray, wanted: int) -> list[Interval]:
    """Intervals from the top that hold the ``wanted`` largest eigenvalues above rounding, few in each."""
    reach = np.abs(off)
    radius = np.append(reach, 0.0) + np.insert(reach, 0, 0.0)
    high = float((diagonal + radius).max())
    scale = max(abs(high), float(np.abs(diagonal - radius).max()))
    if scale == 0.0:
        return []
    high += 1e-12 * scale
    # Below this an eigenvalue cannot be told from zero.
    low = 4 * len(diagonal) * np.finfo(np.float64).eps * scale
    total = int(above(diagonal, off, low)[0])
    wanted = min(wanted, total)
    done: list[Interval] = []
    open_ = [(low, high, 0, total)] if wanted else []
    while open_:
        a, b, rank, count = open_.pop()
        if rank >= wanted or not count:
            continue
        if count <= IN_INTERVAL or b - a <= 1e-12 * scale:
            centre, reach_ = (a + b) / 2, NEAR * (b - a) / 2
            within = above(diagonal, off, np.array([centre - reach_, centre + reach_]))
            done.append(Interval(float(a), float(b), count, rank, int(within[0] - within[1])))
            continue
        middle = _cut(diagonal, off, a, b)
        upper = int(above(diagonal, off, middle)[0]) - rank
        open_ += [(a, middle, rank + upper, count - upper), (middle, b, rank, upper)]
    return sorted(done, key=lambda i: i.rank)


def contour_vectors(matrix: np.ndarray, interval: Interval, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues in the interval, falling, and their unit vectors as columns.

    A circle through the interval's ends is integrated by Gauss-Legendre nodes: at each, a complex shifted
    system is solved for a block of vectors, which the sum projects on the interval's eigenvectors.  A
    Rayleigh-Ritz step takes them out; the block is projected again until its residuals are at rounding.
    The block has room for the eigenvalues just outside, which the projection hardly dampens; should it not
    settle, it is doubled.
    """
    size = len(matrix)
    scale = np.abs(matrix).sum(axis=1).max()
    centre, radius = (interval.low + interval.high) / 2, (interval.high - interval.low) / 2
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    turn = np.exp(-1j * np.pi / 2 * (nodes - 1))
    shifted = [(w / 2, radius * t, (centre + radius * t) * np.eye(size) - matrix) for w, t in zip(weights, turn)]
    block = min(size, max(interval.near + 2, interval.count + 4))
    best = None
    while True:
        vectors = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, block)))[0]
        for _ in range(MOST_ROUNDS):
            projected = sum(w * np.real(t * np.linalg.solve(system, vectors.astype(np.complex128))) for w, t, system in shifted)
            basis = np.linalg.qr(np.linalg.qr(projected)[0])[0]
            values, small = np.linalg.eigh(basis.T @ matrix @ basis)
            vectors = basis @ small
            inside = np.flatnonzero((values > interval.low) & (values <= interval.high))[::-1]
            if len(inside) != interval.count:
                continue
            residual = np.linalg.norm(matrix @ vectors[:, inside] - vectors[:, inside] * values[inside], axis=0).max()
            settled = best is not None and residual > best[0] / 2
            if best is None or residual < best[0]:
                best = (residual, values[inside], vectors[:, inside])
            if settled and best[0] <= 1e-12 * scale:
                return best[1], best[2]
        if block == size:
            break
        block = min(size, 2 * block)
    if best is None or best[0] > 1e-10 * scale:
        raise ArithmeticError(f"contour did not settle on the {interval.count} eigenvalues of {interval}")
    return best[1], best[2]


def principal(spark, covariance: np.ndarray, wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and unit eigenvectors as columns; those that rounding hides are left out.

    Inertia counts cut the spectrum into intervals; each is solved by a task of its own, and all together
    must give as many vectors as there are eigenvalues.
    """
    diagonal, off = tridiagonal(covariance)
    cut = intervals(diagonal, off, wanted)
    if not cut:
        return np.zeros(0), np.zeros((len(covariance), 0))

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                values, vectors = contour_vectors(covariance, Interval(**row))
                yield pa.RecordBatch.from_pydict(
                    {"rank": row["rank"] + np.arange(len(values)), "value": values, "vector": list(vectors.T)}
                )

    rows = spark.createDataFrame([astuple(i) for i in cut], "low double, high double, count long, rank long, near long")
    # One task per interval.
    found = rows.repartitionByRange(len(cut), "rank").mapInArrow(solve, "rank bigint, value double, vector array<double>").collect()
    found.sort(key=lambda r: r["rank"])
    ranks = [r["rank"] for r in found]
    if ranks != list(range(sum(i.count for i in cut))):
        raise ArithmeticError("eigenvalues are missing by their inertia count")
    values = np.array([r["value"] for r in found])[:wanted]
    return values, np.array([r["vector"] for r in found]).T[:, :wanted]


# -- the rows ------------------------------------------------------------------------------------


def _matrix(array: pa.Array, size: int) -> np.ndarray:
    return array.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _sum_of_products(array_name: str, centre: np.ndarray):
    """Per task one row per dimension: the sums of centred products."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(centre)
        total, seen = np.zeros((size, size)), False
        for batch in batches:
            if batch.num_rows:
                rows = _matrix(batch.column(batch.schema.get_field_index(array_name)), size) - centre
                total += rows.T @ rows
                seen = True
        if seen:
            yield pa.RecordBatch.from_pydict({"i": np.arange(size), "products": list(total)})

    return run


def covariance(rows: DataFrame, name: str, count: int, centre: np.ndarray) -> np.ndarray:
    """Covariance (divisor ``count``) of the array column, centred before multiplying.

    Tasks add up their own products; a matrix a task is summed element by element and only the sum, bounded
    by the dimensions, reaches the driver.
    """
    parts = rows.select(name).mapInArrow(_sum_of_products(name, centre), "i bigint, products array<double>")
    cells = parts.select("i", F.posexplode("products").alias("j", "p")).groupBy("i", "j").agg(F.sum("p").alias("p"))
    out = np.zeros((len(centre), len(centre)))
    sums = cells.toArrow()
    out[sums["i"].to_numpy(), sums["j"].to_numpy()] = sums["p"].to_numpy()
    return (out + out.T) / (2 * count)


_ROWS = pa.schema([("deviation", pa.int64()), ("whitened", pa.list_(pa.float64()))])


def _whiten(count: int, sums: list[int], axes: np.ndarray):
    """Adds the exact deviation and the whitened coordinates to rows of vec_id and x."""

    def deviations(rows: np.ndarray) -> list[int]:
        far = max((abs(count * int(e) - s) for edge in (rows.min(axis=0), rows.max(axis=0)) for e, s in zip(edge, sums)), default=0)
        if len(sums) * far * far < 1 << 63:
            apart = count * rows - np.array(sums, np.int64)
            return (apart * apart).sum(axis=1).tolist()
        exact = [sum((count * int(e) - s) ** 2 for e, s in zip(row, sums)) for row in rows]
        if max(exact) >= 1 << 63:
            raise OverflowError("a deviation does not fit 64 bits")
        return exact

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean = np.array([s / count for s in sums])
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _matrix(batch.column(1), len(sums))
            whitened = (rows - mean) @ axes
            flat = pa.array(whitened.ravel())
            ends = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * axes.shape[1])
            added = as_batch(
                _ROWS, {"deviation": deviations(rows), "whitened": pa.ListArray.from_arrays(ends, flat)}
            )
            yield pa.RecordBatch.from_arrays([batch.column(0), *added.columns], names=["vec_id", *_ROWS.names])

    return run


def finite(vector: Column) -> Column:
    return F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))


def whiten(
    vectors: DataFrame, wanted: int = COMPONENTS, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """Each vector along the principal components of all: vec_id, n, deviation, whitened (an array), and the fit.

    An entry c counts as floor(64 c) + 1000000.  Rows whose vector is null or holds a null or non-finite entry
    are left out; so are empty vectors and those of another length than most have (the longer one, if as many).
    All others are the fit list, rows that repeat an id or a vector and rows with a null id included.  Components
    are numbered from 1 by falling eigenvalue; those whose eigenvalue rounding hides are not given, so equal vectors
    alone, or a single one, give no rows, like an empty table.  Entries beyond 2^46 and deviations beyond 64 bits raise.

    ``explained`` has each component's share of the trace, ``identity_error`` the largest entry by which the
    covariance of the written whitened rows differs from the identity.  What is collected is bounded by the
    square of the dimensions; rows are read in four passes and never shuffled.
    """
    spark = vectors.sparkSession
    given = vectors.select(column(id_column).cast("long").alias("vec_id"), column(vector_column).cast("array<double>").alias("vector"))
    given = given.where(F.col("vector").isNotNull() & (F.size("vector") > 0) & finite(F.col("vector")))
    lengths = given.groupBy(F.size("vector").alias("length")).agg(F.count(F.lit(1)).alias("rows"))
    most = lengths.orderBy(F.desc("rows"), F.desc("length")).first()
    ddl = "vec_id long, n long, deviation long, whitened array<double>, explained array<double>, identity_error double"
    if most is None:
        return spark.createDataFrame([], ddl)
    count, size = most["rows"], most["length"]
    if size > MOST_DIMENSIONS:
        raise ValueError(f"{size} dimensions; {MOST_DIMENSIONS} at most")
    whole = F.transform(
        "vector",
        lambda c: F.when(F.abs(c) * SCALE < LARGEST, F.floor(c * SCALE).cast("long") + SHIFT).otherwise(
            F.raise_error(F.lit("an entry is too large")).cast("long")
        ),
    )
    rows = written(given.where(F.size("vector") == size).select("vec_id", whole.alias("x")))

    by_dimension = rows.select(F.posexplode("x").alias("i", "x")).groupBy("i").agg(F.sum(F.col("x").cast("decimal(20,0)")).alias("s"))
    sums = [int(r["s"]) for r in by_dimension.orderBy("i").collect()]
    spread = covariance(rows, "x", count, np.array([s / count for s in sums]))
    values, axes = principal(spark, spread, wanted)
    if not len(values):
        return spark.createDataFrame([], ddl)

    added = "vec_id bigint, deviation bigint, whitened array<double>"
    out = written(rows.mapInArrow(_whiten(count, sums, axes / np.sqrt(values)), added))
    means = out.select(F.posexplode("whitened").alias("i", "w")).groupBy("i").agg((F.sum("w") / count).alias("mean"))
    centre = np.array([r["mean"] for r in means.orderBy("i").collect()])
    error = float(np.abs(covariance(out, "whitened", count, centre) - np.eye(len(values))).max())
    explained = (values / np.trace(spread)).tolist()
    return out.select(
        "vec_id",
        F.lit(count).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.array(*[F.lit(e) for e in explained]).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def by_component(whitened: DataFrame) -> DataFrame:
    """One row per vector and component."""
    each = F.inline(F.arrays_zip(F.sequence(F.lit(1), F.size("whitened")).alias("component"), "whitened", "explained"))
    return whitened.select("vec_id", "n", "deviation", "identity_error", each).select(
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"
    )
