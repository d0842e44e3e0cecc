"""SimHash near-duplicates, with every pair of fingerprints within the radius found by covering hashing."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.llm.common import as_batch, column, fresh, slices
from oreflow.llm.components import components
from oreflow.session import written

BITS = 64
RADIUS = 3
WORDS = 3
SEED = 42
SHINGLES_TOGETHER = 1 << 15
# A bucket of more distinct fingerprints is dealt out again by parts of its other bits.
LARGE_BUCKET = 1 << 16
# Up to this size all pairs of a bucket are compared in memory; beyond, near values are looked up.
COMPARED = 1 << 11


def covering_masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """Masks such that any two values differing in at most ``radius`` bits are equal under one of them.

    Bit i carries a vector of radius + 1 bits, and mask v keeps the bits whose vector has an odd product with
    v.  The vectors of ``radius`` differing bits cannot span the whole space, so some v <> 0 has an even product
    with all of them: its mask leaves exactly these bits out.
    """
    size = (1 << (radius + 1)) - 1
    # Multiplying by 7 spreads the vectors so that neighbouring bits carry different ones.
    vectors = [(i * 7) % size + 1 for i in range(bits)]
    return [sum(1 << i for i, w in enumerate(vectors) if (w & v).bit_count() % 2) for v in range(1, size + 1)]


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprint(text: bytes, words: int = WORDS, seed: int = SEED) -> int:
    """The majority of each bit over the hashes of all word shingles, repeats included; 0 without words."""
    import xxhash

    tokens = text.lower().split()  # on bytes: A-Z, and the six ASCII white-space characters
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    if len(tokens) <= words:
        return xxhash.xxh64_intdigest(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    starts, ends = starts[: len(ends) - words + 1].tolist(), ends[words - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), SHINGLES_TOGETHER):
        hashes = np.array(
            [digest(joined[a:b], seed) for a, b in zip(starts[at : at + SHINGLES_TOGETHER], ends[at : at + SHINGLES_TOGETHER])],
            np.uint64,
        )
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    majority = np.packbits(counts * 2 > len(starts), bitorder="little")
    return int(majority.view("<u8")[0])


_PRINTS = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])


def _fingerprints(words: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text"):
                fps = np.array([fingerprint(t, words, seed) for t in texts], np.uint64)
                yield as_batch(_PRINTS, {"doc_id": part.column(0), "fp": pa.array(fps.view(np.int64))})

    return run


def fingerprints(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = WORDS, seed: int = SEED
) -> DataFrame:
    """(doc_id, fp) per row; a null text counts as empty, and an empty one has fingerprint zero."""
    rows = docs.select(column(id_column).cast("long").alias("doc_id"), column(text_column).cast("string").alias("text"))
    return rows.mapInArrow(_fingerprints(words, seed), "doc_id bigint, fp bigint")


def _forest(values: np.ndarray, mask: int, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links (value, root) that connect what pairs within the radius connect, one per value at most.

    ``values`` are distinct, sorted and equal under ``mask``.
    """
    parent = np.arange(len(values))

    def merge(left: np.ndarray, right: np.ndarray) -> None:
        """Join the components of the pairs: lower both roots to the lesser one until nothing changes."""
        while len(left):
            a, b = parent[left], parent[right]
            low = np.minimum(a, b)
            np.minimum.at(parent, a, low)
            np.minimum.at(parent, b, low)
            while (parent[parent] != parent).any():
                parent[:] = parent[parent]
            open_ = parent[left] != parent[right]
            left, right = left[open_], right[open_]

    if len(values) <= COMPARED:
        for at in range(0, len(values), 256):
            near = np.bitwise_count(values[at : at + 256, None] ^ values[None, :]) <= radius
            left, right = np.nonzero(near)
            left = left + at
            keep = left < right
            merge(left[keep], right[keep])
    else:
        free = [i for i in range(BITS) if not (mask >> i) & 1]
        for size in range(1, radius + 1):
            for flipped in combinations(free, size):
                wanted = values ^ np.uint64(sum(1 << i for i in flipped))
                place = np.minimum(np.searchsorted(values, wanted), len(values) - 1)
                left = np.flatnonzero(values[place] == wanted)
                merge(left[left < place[left]], place[left[left < place[left]]])
    child = np.flatnonzero(parent != np.arange(len(values)))
    if len(child):
        yield values[child], values[parent[child]]


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("bucket", pa.int64()), ("table", pa.int32())])


def _link_buckets(masks: list[int], radius: int, limit: int | None):
    """Over rows sorted by (table, bucket, fp): link each bucket; rows of one above ``limit`` come back as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        held_rows, key, overflow = 0, None, False

        def close() -> Iterator[pa.RecordBatch]:
            if held_rows < 2:
                return
            values = np.sort(np.concatenate(held).view(np.uint64))
            for child, root in _forest(values, masks[key[0]], radius):
                yield as_batch(
                    _LINKS,
                    {
                        "a": pa.array(child.view(np.int64)),
                        "b": pa.array(root.view(np.int64)),
                        "bucket": pa.nulls(len(child), pa.int64()),
                        "table": pa.nulls(len(child), pa.int32()),
                    },
                )

        def spill(values: np.ndarray) -> pa.RecordBatch:
            return as_batch(
                _LINKS,
                {
                    "a": pa.array(values),
                    "b": pa.nulls(len(values), pa.int64()),
                    "bucket": pa.array(np.full(len(values), key[1])),
                    "table": pa.array(np.full(len(values), key[0]), pa.int32()),
                },
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            table, bucket, fp = (
                batch.column(batch.schema.get_field_index(n)).to_numpy() for n in ("table", "bucket", "fp")
            )
            extra = batch.column(batch.schema.get_field_index("extra")).to_numpy()
            change = (np.diff(table) != 0) | (np.diff(bucket) != 0) | (np.diff(extra) != 0)
            edges = np.concatenate([[0], np.flatnonzero(change) + 1, [len(fp)]])
            for first, last in zip(edges[:-1].tolist(), edges[1:].tolist()):
                own = (int(table[first]), int(bucket[first]), int(extra[first]))
                if own != key:
                    if not overflow:
                        yield from close()
                    held, held_rows, key, overflow = [], 0, own, False
                held.append(fp[first:last])
                held_rows += last - first
                if limit and held_rows > limit:
                    overflow = True
                if overflow:
                    yield spill(np.concatenate(held))
                    held = []
        if not overflow:
            yield from close()

    return run


def _dealt(rows: DataFrame) -> DataFrame:
    key = ["table", "bucket", "extra"]
    return rows.select(*key, "fp").repartition(*key).sortWithinPartitions(*key)


def near_links(prints: DataFrame, radius: int = RADIUS, limit: int = LARGE_BUCKET) -> DataFrame:
    """Links (a, b) between distinct values of ``fp`` that connect all pairs within ``radius`` bits.

    Each value goes under every covering mask into a bucket; a bucket gives one link per value at most, enough
    to connect what its near pairs connect, so a crowded bucket's result grows with its size, not its square.
    A bucket with more than ``limit`` values is not held by a task: its values are dealt out once more, by each
    of radius + 1 parts of the bits its mask leaves out, one of which any near pair shares.  A bucket is then
    no larger than the values of the bits that are left.
    """
    masks = covering_masks(radius)
    tables = F.array(
        *[
            F.struct(F.lit(i).alias("table"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("bucket"))
            for i, m in enumerate(masks)
        ]
    )
    ddl = "a bigint, b bigint, bucket bigint, table int"
    spread = prints.select("fp").distinct().select("fp", F.explode(tables).alias("t")).select(
        "fp", "t.table", "t.bucket", F.lit(0).cast("long").alias("extra")
    )
    first = written(_dealt(spread).mapInArrow(_link_buckets(masks, radius, limit), ddl))
    crowded = first.where("b IS NULL")
    if crowded.isEmpty():
        return first.select("a", "b")
    # Part k of the free bits of a mask; the part's number goes into the top bits, which its own bits leave free.
    finer: list[int] = []
    parts = []
    for i, mask in enumerate(masks):
        free = [b for b in range(BITS) if not (mask >> b) & 1]
        for k in range(radius + 1):
            part = sum(1 << b for b in free[k :: radius + 1])
            parts.append((i, len(finer), part))
            finer.append(mask | part)
    again = F.filter(
        F.array(
            *[
                F.struct(
                    F.lit(i).alias("of"),
                    F.lit(n).alias("table"),
                    F.col("a").bitwiseAND(F.lit(signed(part))).alias("extra"),
                )
                for i, n, part in parts
            ]
        ),
        lambda x: x["of"] == F.col("table"),
    )
    spread = crowded.select(F.col("a").alias("fp"), "bucket", F.explode(again).alias("t")).select(
        "fp", "t.table", "bucket", "t.extra"
    )
    second = _dealt(spread).mapInArrow(_link_buckets(finer, radius, None), ddl)
    return first.where("b IS NOT NULL").unionByName(second).select("a", "b")


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    words: int = WORDS,
    radius: int = RADIUS,
    seed: int = SEED,
    limit: int = LARGE_BUCKET,
) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    Texts are lower-cased in A-Z, cut at ASCII white space into words and hashed by shingles of ``words`` words
    (the whole text if it has fewer); null counts as empty, and texts without words have fingerprint zero and
    are linked like any other.  Fingerprints within ``radius`` bits are linked, and component_id is the
    smallest id that links lead to (null only if all ids of the component are null).  Rows of one id are
    separate documents; an empty table gives an empty result; other columns are not read.

    Copies share a fingerprint and are compared once; they meet again only in a join that Spark can split.
    """
    prints = written(fingerprints(docs, id_column, text_column, words, seed))
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(near_links(distinct, radius, limit))
    rooted = written(
        distinct.join(roots.select(F.col("a").alias("fp"), F.col("b").alias("root")), "fp", "left").select(
            "fp", "least", F.coalesce("root", "fp").alias("root")
        )
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.join(least, "root").select("fp", "component_id")
    return prints.join(classes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_first(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", radius: int = RADIUS, limit: int = LARGE_BUCKET
) -> DataFrame:
    """The rows of ``docs``, all columns, that come first in their group of near-duplicates.

    First is the smallest id, null last, then the smallest hash of the text; of rows equal in both all stay out
    but one.  Texts are read twice: once for the fingerprints, and once to pick rows by (id, hash).
    """
    (key,) = fresh(docs, "key")
    text = F.coalesce(column(text_column).cast("string"), F.lit(""))
    name = F.md5(F.concat_ws(":", F.coalesce(column(id_column).cast("string"), F.lit("null")), text))
    keyed = docs.select(column(id_column).cast("long").alias("doc_id"), name.alias("key"), text.alias("text"))
    prints = written(keyed.mapInArrow(_keyed_fingerprints(WORDS, SEED), "doc_id bigint, key string, fp bigint"))
    distinct = written(prints.select("fp").distinct())
    roots = components(near_links(distinct, radius, limit)).select(F.col("a").alias("fp"), "b")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")
    best = (
        prints.groupBy("fp")
        .agg(F.min(place).alias("best"))
        .join(roots, "fp", "left")
        .groupBy(F.coalesce("b", "fp"))
        .agg(F.min("best").alias("best"))
        .select(F.col("best.key").alias(key))
    )
    # Rows equal in id and text share a key: one of them stays.
    return docs.withColumn(key, name).join(best, key, "left_semi").dropDuplicates([key]).drop(key)


def _keyed_fingerprints(words: int, seed: int):
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.string()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text"):
                fps = np.array([fingerprint(t, words, seed) for t in texts], np.uint64)
                yield as_batch(
                    schema, {"doc_id": part.column(0), "key": part.column(1), "fp": pa.array(fps.view(np.int64))}
                )

    return run
