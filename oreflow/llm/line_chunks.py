"""Removal of passages that repeat across documents: whole runs of lines, and chunks cut where their content says."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.llm.common import as_batch, column, fresh, slices
from oreflow.session import written

# Every shared run of lines with more words than this goes whole, wherever it begins and ends.
PASSAGE_WORDS = 50
# Lines the rolling hash looks back on.
WINDOW = 2
BASE = 1_000_003
PRIME = 2_147_483_647


def _rolling(hashes: Column) -> Column:
    """At each line, the polynomial of the hashes of the last WINDOW lines, modulo a prime."""

    def at(line: Column, i: Column) -> Column:
        value = F.lit(0).cast("long")
        for back in range(WINDOW - 1, -1, -1):
            seen = F.coalesce(F.get(hashes, i - back), F.lit(0).cast("long"))
            value = (value * BASE + seen) % PRIME
        return value

    return F.transform(hashes, at)


def chunks_of(hashes: Column) -> Column:
    """The chunks of a document as (first, size) in lines, first from 0.

    A chunk ends after a line whose rolling hash is lower than that of the line before and no higher than that
    of the line after: every third line on average, and never two in a row.  This depends on four neighbouring
    lines alone, so text put in earlier moves a boundary but does not change it.
    """

    def ends_of(rolled: Column) -> Column:
        last = F.size(rolled) - 1
        low = lambda r, i: (i > 0) & (r < F.get(rolled, i - 1)) & (r <= F.get(rolled, i + 1))
        return F.filter(
            F.transform(rolled, lambda r, i: F.when((i == last) | low(r, i), i).otherwise(-1)), lambda i: i >= 0
        )

    return F.transform(
        F.transform(F.array(_rolling(hashes)), ends_of),
        lambda e: F.transform(
            e,
            lambda end, n: F.struct(
                (F.coalesce(F.get(e, n - 1), F.lit(-1)) + 1).alias("first"),
                (end - F.coalesce(F.get(e, n - 1), F.lit(-1))).alias("size"),
            ),
        ),
    )[0]


def passages_of(text: bytes, words: int = PASSAGE_WORDS) -> list[tuple[int, int, int]]:
    """The shortest runs of lines with more than ``words`` words that start, or end, at each line that has words.

    As (first, size, hash), first from 0.  Those inside a longer run cover it from its first line with words to its
    last, so that two texts share a run if and only if they share all of these.
    """
    import xxhash

    lines = text.split(b"\n")
    counts = np.fromiter((len(line.split()) for line in lines), np.int64, len(lines))
    if counts.sum() <= words:
        return []
    full = np.flatnonzero(counts)
    total = np.concatenate([[0], np.cumsum(counts[full])])
    # Runs full[a] to full[b - 1]: the least b for every a, and the greatest a for every b.
    ends = np.searchsorted(total, total[:-1] + words, "right")
    starts = np.searchsorted(total, total[1:] - words, "left") - 1
    runs = {(a, b) for a, b in enumerate(ends.tolist()) if b < len(total)}
    runs |= {(a, b) for b, a in enumerate(starts.tolist(), 1) if a >= 0}
    at = np.concatenate([[0], np.cumsum(np.fromiter(map(len, lines), np.int64, len(lines)) + 1)]).tolist()
    out = []
    for a, b in sorted(runs):
        first, last = int(full[a]), int(full[b - 1])
        out.append((first, last - first + 1, xxhash.xxh64_intdigest(text[at[first] : at[last + 1] - 1])))
    return out


_FOUND = pa.schema([("doc", pa.int64()), ("first", pa.int32()), ("size", pa.int32()), ("hash", pa.int64())])


def _passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in slices(batch, "text"):
            found = [(doc, *run) for doc, text in zip(part.column(0).to_pylist(), texts) for run in passages_of(text)]
            if found:
                doc, first, size, hashes = zip(*found)
                hashes = pa.array(np.array(hashes, np.uint64).view(np.int64))
                yield as_batch(_FOUND, {"doc": doc, "first": first, "size": size, "hash": hashes})


def _ranges(marks: Column) -> Column:
    """Runs (first, size) that may overlap or touch as those that do not, in order."""
    lines = F.sort_array(
        F.array_distinct(F.flatten(F.transform(marks, lambda m: F.sequence(m["first"], m["first"] + m["size"] - 1))))
    )

    def bounds(n: Column) -> Column:
        firsts = F.filter(n, lambda line, i: (i == 0) | (F.get(n, i - 1) != line - 1))
        lasts = F.filter(n, lambda line, i: (i == F.size(n) - 1) | (F.get(n, i + 1) != line + 1))
        return F.zip_with(firsts, lasts, lambda a, b: F.struct(a.alias("first"), (b - a + 1).alias("size")))

    return F.transform(F.array(lines), bounds)[0]


def dedup_line_chunks(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", removed: str | None = None
) -> DataFrame:
    """All rows and columns of ``docs``; the text without passages that occur elsewhere.

    A passage is a run of lines with more than PASSAGE_WORDS words, single lines included, whatever stands around
    it; or a content-defined chunk of two or more lines, whatever its words.  Of equal ones the first stays: in the
    smallest id (null last), then the smallest hash of the text, then the first line; so does what overlaps it in
    its own text.  Where passages overlap, each line that goes still stands in an earlier place.  A text that loses nothing comes back as it was, null included; one that loses all its lines is
    empty.  Rows equal in id and text are one document and keep or lose the same.  Chunks of blank lines only
    are left alone.  ``removed`` names an extra column with the removed lines' ranges (null if none).  An empty
    table gives an empty result.

    Hashes of passages are counted first.  Texts are shuffled once, to meet the list of their own repeated hashes;
    only passages on such a list are sent out as text, and grouped by hash and bytes, so that a chance collision
    removes nothing.  A passage in very many documents is an aggregate and a join, both of which Spark spreads.
    """
    key, marks, doc = fresh(docs, "key", "marks", "doc")
    text = column(text_column).cast("string")
    # Rows that agree in id and text share a key; whatever the length, it is 32 characters.
    keyed = docs.withColumn(
        key,
        F.md5(F.concat_ws(":", F.coalesce(column(id_column).cast("string"), F.lit("null")), F.coalesce(text, F.lit("")))),
    )
    slim = keyed.select(
        F.col(key).alias("key"),
        column(id_column).alias("id"),
        F.split(F.coalesce(text, F.lit("")), "\n").alias("lines"),
    )

    def cut(df: DataFrame) -> DataFrame:
        return df.withColumn("hashes", F.transform("lines", lambda l: F.pmod(F.xxhash64(l), F.lit(PRIME))))

    def chunk_hash(chunk: Column) -> Column:
        return F.xxhash64(F.array_join(F.slice("lines", chunk["first"] + 1, chunk["size"]), "\n"))

    several = lambda c: c["size"] > 1
    # Texts go by a hash of their key here: two of one hash share a list, and are told apart by key afterwards.
    chunks = (
        cut(slim)
        .select("key", "lines", F.filter(chunks_of(F.col("hashes")), several).alias("chunks"))
        .select(
            F.xxhash64("key").alias("doc"),
            F.explode(
                F.transform(
                    "chunks", lambda c: F.struct(c["first"].alias("first"), c["size"].alias("size"), chunk_hash(c).alias("hash"))
                )
            ).alias("chunk"),
        )
        .select("doc", "chunk.*")
    )
    runs = keyed.select(F.xxhash64(key).alias("doc"), text.alias("text")).mapInArrow(
        _passages, "doc bigint, first int, size int, hash bigint"
    )
    found = written(chunks.unionByName(runs))
    repeated = found.groupBy("hash", "size").agg(F.count(F.lit(1)).alias("places")).where("places > 1").drop("places")
    listed = (
        found.join(repeated, ["hash", "size"])
        .groupBy(F.col("doc").alias(doc))
        .agg(F.sort_array(F.collect_set(F.struct("first", "size", "hash"))).alias(marks))
    )
    # The texts of passages on a list, with where they are.
    spread = (
        keyed.select(key, column(id_column).alias("id"), F.split(F.coalesce(text, F.lit("")), "\n").alias("lines"))
        .join(listed, F.xxhash64(key) == F.col(doc))
        .select(F.col(key).alias("key"), "id", "lines", F.explode(marks).alias("chunk"))
        .select(
            "key",
            "chunk.*",
            F.struct(F.col("id").isNull().alias("no_id"), "id", "key", "chunk.first").alias("place"),
            F.array_join(F.slice("lines", F.col("chunk.first") + 1, F.col("chunk.size")), "\n").alias("body"),
        )
        .where(F.trim("body", F.lit(" \t\r\n")) != "")
    )
    spread = written(spread)
    first = spread.groupBy("hash", "body").agg(F.min("place").alias("kept"))
    lost = (
        spread.join(first, ["hash", "body"])
        .where("place <> kept AND NOT (key = kept.key AND first < kept.first + size)")
        .groupBy(F.col("key").alias(key))
        .agg(_ranges(F.collect_set(F.struct("first", "size"))).alias(marks))
    )
    stays = F.filter(
        F.split(text, "\n"),
        lambda _, i: ~F.exists(F.col(marks), lambda m: (i >= m["first"]) & (i < m["first"] + m["size"])),
    )
    out = keyed.join(lost, key, "left").withColumn(
        text_column, F.when(F.col(marks).isNull(), text).otherwise(F.array_join(stays, "\n"))
    )
    if removed:
        out = out.withColumn(removed, F.col(marks))
    return out.drop(key, marks)
