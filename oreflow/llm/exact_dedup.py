"""Exact duplicates by polynomial fingerprints that combine from chunks, confirmed byte by byte."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.llm.common import as_batch, column, slices
from oreflow.session import written

WHITE = b" \t\n\x0b\x0c\r"
CHUNK = 1 << 16
# Two primes below 2**31 and a base for each: products and the sums over a chunk stay within 64 bits.
PRIMES = (2147483647, 2147483629)
BASES = (1103515245, 48271 * 40014)

_FIELDS = {
    "doc_id": pa.int64(),
    "points": pa.int64(),
    "length": pa.int64(),
    "sha": pa.string(),
    "chunks": pa.list_(pa.struct([("h1", pa.int64()), ("s1", pa.int64()), ("h2", pa.int64()), ("s2", pa.int64())])),
    "body": pa.binary(),
}
_TYPES = {
    "doc_id": "bigint",
    "points": "bigint",
    "length": "bigint",
    "sha": "string",
    "chunks": "array<struct<h1:bigint,s1:bigint,h2:bigint,s2:bigint>>",
    "body": "binary",
}


def powers(prime: int, base: int, count: int) -> np.ndarray:
    """base**0 .. base**count modulo prime, by doubling."""
    out = np.array([1], np.int64)
    step = base % prime
    while len(out) <= count:
        out = np.concatenate([out, out * step % prime])
        step = step * step % prime
    return out[: count + 1]


def chunk_hashes(body: bytes, tables: list[tuple[int, np.ndarray]], chunk: int) -> list[tuple[int, ...]]:
    """Per chunk and prime: the hash of its bytes, and base**length, by which hashes before it are shifted."""
    out = []
    for first in range(0, len(body), chunk):
        part = np.frombuffer(body, np.uint8, min(chunk, len(body) - first), first).astype(np.int64) + 1
        row: tuple[int, ...] = ()
        for prime, table in tables:
            row += (int(np.dot(part, table[len(part) - 1 :: -1][: len(part)]) % prime), int(table[len(part)]))
        out.append(row)
    return out


def _digest(keep: list[str], primes: tuple[int, int], chunk: int):
    schema = pa.schema([(k, _FIELDS[k]) for k in keep])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [(p, powers(p, b, chunk)) for p, b in zip(primes, BASES)]
        for batch in batches:
            for part, texts in slices(batch, "text"):
                bodies = [t.translate(None, WHITE) for t in texts]
                yield as_batch(
                    schema,
                    {
                        "doc_id": part.column(0),
                        "points": [len(t.decode()) for t in texts],
                        "length": [len(b) for b in bodies],
                        "sha": [hashlib.sha256(b).hexdigest() for b in bodies],
                        "chunks": [
                            [dict(zip(("h1", "s1", "h2", "s2"), c)) for c in chunk_hashes(b, tables, chunk)]
                            for b in bodies
                        ],
                        "body": bodies,
                    },
                )

    return run


def _combined(h: str, s: str, prime: int) -> Column:
    """Fold chunk hashes from left to right: what came before is shifted by the chunk's length."""
    return F.aggregate("chunks", F.lit(0).cast("long"), lambda acc, c: (acc * c[s] + c[h]) % F.lit(prime))


def digests(
    docs: DataFrame, id_column: str, text_column: str, body: bool, primes: tuple[int, int] = PRIMES, chunk: int = CHUNK
) -> DataFrame:
    """Per row: id, code points, sha-256 and polynomial fingerprint of the text without white space."""
    keep = [k for k in _TYPES if body or k != "body"]
    rows = docs.select(column(id_column).cast("long").alias("doc_id"), column(text_column).cast("string").alias("text"))
    hashed = rows.mapInArrow(_digest(keep, primes, chunk), ", ".join(f"{k} {_TYPES[k]}" for k in keep))
    fingerprint = _combined("h1", "s1", primes[0]) * F.lit(1 << 31) + _combined("h2", "s2", primes[1])
    return hashed.withColumn("fingerprint", fingerprint).drop("chunks")


def _best() -> Column:
    """Sorts first the row of a group that stays: most code points, smallest id (null last), then row number."""
    return F.struct((-F.col("points")).alias("less"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")


def exact_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    primes: tuple[int, int] = PRIMES,
    chunk: int = CHUNK,
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if identical without ASCII white space; a null text counts as empty.  Of equal texts the
    row with the most code points stays, then the smallest id; null ids come last, and of rows equal in both
    exactly one stays.  An empty table gives an empty result; other columns are not read.

    The first scan keeps only a fingerprint and the length of each text.  Texts whose fingerprint occurs once
    are settled by that.  The others are compared chunk by chunk with the best row of their fingerprint; rows
    that differ from it (a collision) go into another round among themselves, so no fingerprint is trusted.
    A hot group is an aggregate and a join with its one best row, which Spark splits, not one task's work.
    """
    spark = docs.sparkSession
    group = ["fingerprint", "length"]
    slim = written(digests(docs, id_column, text_column, False, primes, chunk))
    repeated = slim.groupBy(*group).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").drop("rows")
    single = slim.join(repeated, group, "left_anti").select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
    members = written(
        digests(docs, id_column, text_column, True, primes, chunk)
        .join(repeated, group, "left_semi")
        .withColumn("row", F.monotonically_increasing_id())
    )
    out = single
    pending = members
    while True:
        best = pending.groupBy(*group).agg(F.min(_best()).alias("best"))
        best = best.select(*group, F.col("best.row").alias("leader"), F.col("best.doc_id").alias("keep_id"))
        marked = pending.join(best, group)
        whole = marked.where("row = leader").select("leader", _parts(chunk)).select("leader", "part.*")
        parts = marked.select("row", "leader", _parts(chunk)).select("row", "leader", "part.*")
        same = (
            parts.join(whole.withColumnRenamed("bytes", "expected"), ["leader", "number"])
            .groupBy("row", "leader")
            .agg(F.bool_and(F.col("bytes") == F.col("expected")).alias("same"))
        )
        compared = written(
            marked.select("row", "doc_id", "points", "sha", "leader", "keep_id").join(same, ["row", "leader"])
        )
        equal = compared.where("same")
        sizes = equal.groupBy("leader").agg(F.count(F.lit(1)).alias("group_size"))
        out = out.unionByName(
            equal.join(sizes, "leader").select(
                "doc_id",
                "keep_id",
                "group_size",
                (F.col("row") == F.col("leader")).alias("kept"),
                F.col("sha").alias("text_sha256"),
            )
        )
        other = compared.where("NOT same").select("row")
        if other.isEmpty():
            return out
        pending = written(pending.join(other, "row", "left_semi"))


def _parts(chunk: int) -> Column:
    """The text as numbered chunks of bytes, one row each; an empty text has one empty chunk."""
    last = F.greatest(F.ceil(F.col("length") / chunk), F.lit(1)) - 1
    numbers = F.sequence(F.lit(0).cast("long"), last.cast("long"))
    return F.explode(
        F.transform(
            numbers,
            lambda i: F.struct(
                i.alias("number"),
                F.substring("body", (i * chunk + 1).cast("int"), F.lit(chunk)).alias("bytes"),
            ),
        )
    ).alias("part")
