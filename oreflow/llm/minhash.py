"""Near-duplicates by b-bit MinHash: bands propose, packed low bits estimate, whole shingle sets decide."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.llm.common import as_batch, column, slices
from oreflow.llm.components import components
from oreflow.session import written

WORDS = 4
# Links need 100 * intersection >= PERCENT * union.
PERCENT = 80
SEED = 42
# Two sets of similarity s agree in a band with chance s ** BAND_ROWS: at 0.8 all bands differ for 5 pairs in 10^8.
BANDS, BAND_ROWS = 32, 4
MINIMA = BANDS * BAND_ROWS
# Low bits kept of each least value; 64 / BITS of them fill a word of the signature.
BITS = 2
WORDS_PER_SIGNATURE = MINIMA * BITS // 64
# An estimate so many standard deviations below the limit rules a pair out (one true pair in 10^9).
DEVIATIONS = 6.0
# Sets of a bucket that are compared with each other; a larger bucket is dealt into parts of about this size.
PART = 1 << 11
# Sets that one cell of a group compares with a slice of the group's members.
CELL = 1 << 10
TOGETHER = 1 << 10
# The bit array that tells which texts to read again is no larger than this (16 MB).
MOST_BITS = 27

_MULTIPLIERS = np.random.default_rng(SEED).integers(0, 1 << 31, (MINIMA, 1), np.uint32) * np.uint32(2) + np.uint32(1)
_MIX = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
_LOW_OF_EACH = np.uint64(sum(1 << i for i in range(0, 64, BITS)))


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """The distinct 64-bit hashes of all shingles, sorted; the whole text is one if it has fewer words; none without."""
    import xxhash

    tokens = text.lower().split()  # on bytes: A-Z, and the six ASCII white-space characters
    if not tokens:
        return np.zeros(0, np.uint64)
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = min(words, len(tokens))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(ends) - size + 1].tolist(), ends[size - 1 :].tolist())
    return np.unique(np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, len(ends) - size + 1))


def minima(hashes: np.ndarray) -> np.ndarray:
    """The least value of each of MINIMA multiplicative hashes over a set that is not empty."""
    mixed = (hashes ^ (hashes >> np.uint64(32))).astype(np.uint32)
    least = np.full(MINIMA, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(mixed), TOGETHER):
        values = _MULTIPLIERS * mixed[None, at : at + TOGETHER]
        np.minimum(least, (values ^ (values >> np.uint32(15))).min(axis=1), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    """One key per band, of the whole values of its minima."""
    keys = np.arange(BANDS, dtype=np.uint64) * _MIX[2]
    for half in least.view(np.uint64).reshape(BANDS, BAND_ROWS // 2).T:
        keys = (keys ^ half) * _MIX[0]
        keys = (keys ^ (keys >> np.uint64(32))) * _MIX[1]
    return keys.view(np.int64)


def signature(least: np.ndarray) -> bytes:
    """The low BITS of every minimum, packed into 64-bit words."""
    low = (least & np.uint32((1 << BITS) - 1)).astype(np.uint64).reshape(WORDS_PER_SIGNATURE, -1)
    shifts = np.arange(low.shape[1], dtype=np.uint64) * np.uint64(BITS)
    return np.bitwise_or.reduce(low << shifts, axis=1).tobytes()


def agreements(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many minima agree in their low bits, for signatures (rows) on either side."""
    out = np.zeros((len(left), len(right)), np.int64)
    for word in range(WORDS_PER_SIGNATURE):
        differ = left[:, word, None] ^ right[None, :, word]
        for bit in range(1, BITS):
            differ |= differ >> np.uint64(bit)
        out += np.bitwise_count(differ & _LOW_OF_EACH)
    return MINIMA - out


# Low bits of different minima agree by chance in one of 2 ** BITS cases.
CHANCE = 2.0**-BITS


def similarity(agreeing: np.ndarray) -> np.ndarray:
    """The Jaccard similarity that so many agreements estimate, corrected for low bits that collide."""
    return (agreeing / MINIMA - CHANCE) / (1 - CHANCE)


def least_estimate(percent: int) -> float:
    """A pair at the limit is estimated below this in one case of 10^9."""
    p = percent / 100 * (1 - CHANCE) + CHANCE
    return percent / 100 - DEVIATIONS * math.sqrt(p * (1 - p) / MINIMA) / (1 - CHANCE)


def likely(left: np.ndarray, left_sizes, right: np.ndarray, right_sizes, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Estimates for signatures on either side, and which pairs neither they nor the sets' sizes rule out."""
    estimate = similarity(agreements(left, right))
    few, many = np.minimum(left_sizes, right_sizes), np.maximum(left_sizes, right_sizes)
    return estimate, (estimate >= least_estimate(percent)) & (100 * few >= percent * many)


def linked(left: np.ndarray, right: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets that are not empty reach the limit."""
    if 100 * min(len(left), len(right)) < percent * max(len(left), len(right)):
        return False
    at = np.minimum(np.searchsorted(right, left), len(right) - 1)
    common = int(np.count_nonzero(right[at] == left))
    return 100 * common >= percent * (len(left) + len(right) - common)


def _by_name(batch: pa.RecordBatch) -> dict[str, pa.Array]:
    return dict(zip(batch.schema.names, batch.columns))


_PRINTS = pa.schema(
    [
        ("doc_id", pa.int64()), ("key", pa.string()), ("digest", pa.string()), ("size", pa.int64()),
        ("bits", pa.binary()), ("bands", pa.list_(pa.int64())),
    ]
)
_PRINTS_DDL = "doc_id bigint, key string, digest string, size bigint, bits binary, bands array<bigint>"


def _prints(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text"):
                sets = [shingles(t, words) for t in texts]
                least = [minima(s) if len(s) else None for s in sets]
                yield as_batch(
                    _PRINTS,
                    {
                        "doc_id": part.column(0),
                        "key": part.column(1),
                        "digest": [hashlib.md5(s.tobytes()).hexdigest() if len(s) else None for s in sets],
                        "size": [len(s) for s in sets],
                        "bits": [None if m is None else signature(m) for m in least],
                        "bands": [None if m is None else band_keys(m) for m in least],
                    },
                )

    return run


_TIES = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("estimate", pa.float64())])
_TIES_DDL = "a bigint, b bigint, estimate double"


def _ties(percent: int):
    """Over rows sorted by (band, part): per set its likeliest partner, and ties that connect all likely pairs.

    A tie has no estimate.  At most two rows a set leave a bucket, however many pairs are likely in it.
    """

    def close(names: list[int], sizes: list[int], bits: list[bytes]) -> Iterator[pa.RecordBatch]:
        if len(names) < 2:
            return
        size, sign = np.array(sizes), np.frombuffer(b"".join(bits), np.uint64).reshape(len(names), -1)
        label = np.arange(len(names))
        partners, ties = [], []
        for at in range(0, len(names), 256):
            estimate, possible = likely(sign[at : at + 256], size[at : at + 256, None], sign, size, percent)
            rows = np.arange(len(estimate))
            possible[rows, at + rows] = False
            best = np.where(possible, estimate, -np.inf)
            partner = best.argmax(axis=1)
            for i in np.flatnonzero(possible.any(axis=1)).tolist():
                partners.append((names[at + i], names[partner[i]], float(best[i, partner[i]])))
                near, mine = label[possible[i]], label[at + i]
                for other in set(near[near != mine].tolist()):
                    ties.append((names[other], names[mine], None))
                    label[label == other] = mine
        for some in (partners, ties):
            if some:
                yield as_batch(_TIES, dict(zip(_TIES.names, map(list, zip(*some)))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, names, sizes, bits = None, [], [], []
        for batch in batches:
            columns = _by_name(batch)
            rows = zip(*(columns[n].to_pylist() for n in ("band", "part", "name", "size", "bits")))
            for band, part, name, size, own in rows:
                if (band, part) != key:
                    yield from close(names, sizes, bits)
                    key, names, sizes, bits = (band, part), [], [], []
                names.append(name)
                sizes.append(size)
                bits.append(own)
        yield from close(names, sizes, bits)

    return run


_SETS = pa.schema([("key", pa.string()), ("items", pa.binary())])


def _slot(bits: int) -> Column:
    return F.pmod(F.xxhash64("key"), F.lit(bits))


def _marked(keys: DataFrame) -> tuple[int, np.ndarray]:
    """A bit array in which each key's slot is set: at most 2**MOST_BITS bits, 16 a key where that is enough."""
    bits = 1 << min(MOST_BITS, max(10, (16 * keys.count()).bit_length()))
    set_ = F.call_function("shiftleft", F.lit(1).cast("long"), _slot(bits).bitwiseAND(63).cast("int"))
    words = keys.groupBy(F.shiftright(_slot(bits), 6).alias("word")).agg(F.bit_or(set_).alias("set")).toArrow()
    table = np.zeros(bits // 64, np.int64)
    table[words["word"].to_numpy()] = words["set"].to_numpy()
    return bits, table.view(np.uint64)


def _sets(words: int, marked: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = _by_name(batch)["slot"].to_numpy().astype(np.uint64)
            wanted = marked[slot >> np.uint64(6)] >> (slot & np.uint64(63)) & np.uint64(1)
            for part, texts in slices(batch.filter(pa.array(wanted.astype(bool))), "text"):
                yield as_batch(_SETS, {"key": part.column(0), "items": [shingles(t, words).tobytes() for t in texts]})

    return run


def _sets_of(texts: DataFrame, named: DataFrame, words: int) -> DataFrame:
    """(name, items) for the keys and names given.

    Texts are read again, but not shuffled: a bit array of bounded size sorts most others out where they are read,
    and only the sets of the rest meet the names.
    """
    bits, marked = _marked(named.select("key"))
    found = texts.select("key", "text", _slot(bits).alias("slot")).mapInArrow(_sets(words, marked), "key string, items binary")
    return found.join(named.select("key", "name"), "key").select("name", "items").dropDuplicates(["name"])


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = _by_name(batch)
            pairs = zip(*(columns[n] for n in ("a", "b", "left", "right")))
            links = [
                (a.as_py(), b.as_py())
                for a, b, left, right in pairs
                if linked(np.frombuffer(left.as_buffer(), np.uint64), np.frombuffer(right.as_buffer(), np.uint64), percent)
            ]
            if links:
                yield as_batch(_LINKS, dict(zip(_LINKS.names, map(list, zip(*links)))))

    return run


def _compare_cells(percent: int):
    """Over rows sorted by (root, cell, slice, member): compare a cell's outsiders with the members that follow.

    A task holds one cell of outsiders; members pass by.  Pairs of one label are passed over, and a link
    gives its two sets one label for the rest of the cell.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, names, labels, sizes, sign, items = None, [], [], [], [], []
        matrix = size = None
        for batch in batches:
            columns = _by_name(batch)
            links = []
            rows = zip(*(columns[n] for n in ("root", "cell", "slice", "member", "name", "label", "bits", "items")))
            for root, cell, piece, member, name, label, bits, raw in rows:
                own = (root.as_py(), cell.as_py(), piece.as_py())
                if own != key:
                    key, names, labels, sizes, sign, items, matrix = own, [], [], [], [], [], None
                values = np.frombuffer(raw.as_py(), np.uint64)
                name, label = name.as_py(), label.as_py()
                if not member.as_py():
                    names.append(name)
                    labels.append(label)
                    sizes.append(len(values))
                    sign.append(bits.as_py())
                    items.append(values)
                    continue
                if not names:
                    continue
                if matrix is None:
                    matrix = np.frombuffer(b"".join(sign), np.uint64).reshape(len(names), -1)
                    size, labels = np.array(sizes), np.array(labels, np.int64)
                own = np.frombuffer(bits.as_py(), np.uint64)[None, :]
                possible = likely(own, len(values), matrix, size, percent)[1][0]
                for i in np.flatnonzero(possible & (labels != label)).tolist():
                    if labels[i] != label and linked(items[i], values, percent):
                        links.append((names[i], name))
                        labels[labels == labels[i]] = label
            if links:
                yield as_batch(_LINKS, dict(zip(_LINKS.names, map(list, zip(*links)))))

    return run


def _dealt(prints: DataFrame, part: int) -> DataFrame:
    """(band, part, name, size, bits) of the bands that sets share; a bucket above ``part`` sets is cut by hash.

    Only bands and names are shuffled to find shared bands; signatures join what is left.
    """
    spread = prints.select("name", F.explode("bands").alias("band"))
    shared = spread.groupBy("band").agg(F.count(F.lit(1)).alias("sets"), F.min("name").alias("least")).where("sets > 1")
    parts = F.ceil(F.col("sets") / F.lit(part))
    placed = spread.join(shared, "band").select(
        "band",
        F.pmod(F.xxhash64("name", "band"), parts).alias("part"),
        "name",
        F.when(parts > 1, F.col("least")).alias("least"),
    )
    return placed.join(prints.select("name", "size", "bits"), "name")


def near_sets(texts: DataFrame, prints: DataFrame, words: int, percent: int, part: int = PART, cell: int = CELL) -> DataFrame:
    """(a, b): b the least name that links lead to from the set named a, for sets that are not it themselves.

    ``prints`` has one row per distinct set that is not empty: name (a number), key of a text in ``texts``, size,
    bits, bands.

    A bucket gives each set's likeliest partner and ties between likely ones; the parts of a large bucket are
    tied together unseen.  Of all buckets each set's best partner is compared with it by whole sets, which
    links most of what belongs together.  Ties make groups; where a group is not yet one component, the sets
    outside its largest component are compared with all its members, as pairs inside that add nothing.
    Outsiders lie in cells, members in slices, so a group of any size is spread, and none of its pairs is
    left out.  Only a pair that the estimate rules out by DEVIATIONS is not compared by whole sets.
    """
    buckets = written(_dealt(prints, part))
    order = ["band", "part"]
    # The work lies in comparing, not in bytes, so the number of tasks is not left to their size.
    tasks = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = buckets.select(*order, "name", "size", "bits").repartition(tasks, *order).sortWithinPartitions(*order)
    found = written(dealt.mapInArrow(_ties(percent), _TIES_DDL))
    unseen = buckets.where("least IS NOT NULL AND name <> least").select(F.col("name").alias("a"), F.col("least").alias("b"))
    ties = found.select("a", "b").unionByName(unseen)

    best = found.where("estimate IS NOT NULL").groupBy("a").agg(F.max(F.struct("estimate", "b")).alias("best"))
    pairs = best.select(F.least("a", "best.b").alias("a"), F.greatest("a", "best.b").alias("b")).distinct()
    groups = components(ties)
    grouped = written(
        groups.select(F.col("a").alias("name"), F.col("b").alias("root"))
        .unionByName(groups.select(F.col("b").alias("name"), F.col("b").alias("root")).distinct())
        .join(prints.select("name", "key", "bits"), "name")
    )
    sets = written(_sets_of(texts, grouped, words))
    whole = pairs.join(sets.select(F.col("name").alias("a"), F.col("items").alias("left")), "a").join(
        sets.select(F.col("name").alias("b"), F.col("items").alias("right")), "b"
    )
    first = written(whole.select("a", "b", "left", "right").mapInArrow(_confirm(percent), "a bigint, b bigint"))

    labels = components(first).select(F.col("a").alias("name"), F.col("b").alias("label"))
    labelled = written(grouped.join(labels, "name", "left").withColumn("label", F.coalesce("label", "name")))
    components_of = labelled.groupBy("root", "label").agg(F.count(F.lit(1)).alias("sets"))
    open_ = components_of.groupBy("root").agg(
        F.count(F.lit(1)).alias("parts"), F.sum("sets").alias("members"), F.max(F.struct("sets", "label")).alias("largest")
    ).where("parts > 1")
    open_ = open_.select(
        "root",
        F.col("largest.label").alias("largest"),
        F.ceil((F.col("members") - F.col("largest.sets")) / F.lit(cell)).alias("cells"),
        F.ceil(F.col("members") / F.lit(cell * 16)).alias("slices"),
    )
    of_open = labelled.join(open_, "root")
    place = ["root", "cell", "slice"]
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    drawn = lambda n, seed: F.pmod(F.xxhash64("name", F.lit(seed)), F.col(n))
    outsiders = of_open.where("label <> largest").withColumn("cell", drawn("cells", 1)).withColumn("slice", every("slices"))
    members = of_open.withColumn("slice", drawn("slices", 2)).withColumn("cell", every("cells"))
    both = [
        side.select(*place, F.lit(member).alias("member"), "name", "label", "bits")
        for side, member in ((outsiders, False), (members, True))
    ]
    cells = both[0].unionByName(both[1]).join(sets, "name").select(*place, "member", "label", "name", "bits", "items")
    cells = cells.repartition(tasks, *place).sortWithinPartitions(*place, "member")
    second = cells.mapInArrow(_compare_cells(percent), "a bigint, b bigint")
    return components(first.unionByName(second))


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
    part: int = PART,
    cell: int = CELL,
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Texts are lower-cased in A-Z and cut at ASCII white space; a document's set holds its distinct shingles of
    ``words`` words (the whole sequence if it has fewer), compared by 64-bit hashes.  Two are linked if their sets
    have 100 * intersection >= ``percent`` * union, and component_id is the smallest id that links lead to, null only
    if all ids of the component are.  A null, empty or blank text has no set and no link: it is its own component.
    Rows that repeat an id or a text are documents of their own; ``kept`` is doc_id = component_id, nulls
    being equal; an empty table gives an empty result; other columns are not read.

    Copies of a set are one set from the start, and meet again only in joins that Spark can split.
    """
    text = F.coalesce(column(text_column).cast("string"), F.lit(""))
    doc_id = column(id_column).cast("long")
    key = F.md5(F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("null")), text))
    keyed = docs.select(doc_id.alias("doc_id"), key.alias("key"), text.alias("text"))
    prints = written(keyed.mapInArrow(_prints(words), _PRINTS_DDL))
    first = F.first(F.struct("key", "size", "bits", "bands")).alias("one")
    distinct = prints.where("digest IS NOT NULL").groupBy("digest").agg(first, F.min("doc_id").alias("least"))
    # Numbered once and written: short names for all that follows.
    distinct = written(distinct.select(F.monotonically_increasing_id().alias("name"), "digest", "one.*", "least"))
    roots = near_sets(keyed.select("key", "text"), distinct.drop("digest", "least"), words, percent, part, cell)
    rooted = distinct.select("name", "digest", "least").join(
        roots.select(F.col("a").alias("name"), F.col("b").alias("root")), "name", "left"
    )
    rooted = written(rooted.withColumn("root", F.coalesce("root", "name")))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.join(least, "root").select("digest", "component_id")
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return prints.select("doc_id", "digest", "size").join(classes, "digest", "left").select(
        "doc_id",
        F.col("size").alias("n_shingles"),
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )
