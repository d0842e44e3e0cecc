"""Packing documents into training sequences beside their lexical neighbours."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.llm.common import as_batch, column, slices
from oreflow.llm.tokens import encoder
from oreflow.session import written

WINDOW = 4096
END = 2
# Ids in one inverted index; a task builds one after the other, so this bounds what it holds.
SHARD_IDS = 1 << 19
K1, B = 1.2, 0.75
# Two multiplicative hashes of ids, whose least values over a document say which shard suits it.
MULTIPLIERS = (2654435761, 2246822519)

_TOKENS = pa.schema(
    [("doc_id", pa.int64()), ("copy", pa.int64()), ("ids", pa.binary()), ("near", pa.int64()), ("near_too", pa.int64())]
)


@cache
def _ranks(vocabulary: int, end_id: int, width: str) -> list[np.ndarray]:
    """Place of every id in the order of each hash, the end id last; an odd multiplier keeps hashes apart."""
    ranks = []
    for multiplier in MULTIPLIERS:
        mixed = (np.arange(vocabulary, dtype=np.uint64) * np.uint64(multiplier)) & np.uint64(0xFFFFFFFF)
        mixed[end_id] = 1 << 32
        rank = np.empty(vocabulary, width)
        rank[np.argsort(mixed)] = np.arange(vocabulary)
        ranks.append(rank)
    return ranks


def _tokenize(tokenizer: str, end_id: int, vocabulary: int, width: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = np.dtype(width).itemsize
        ranks = _ranks(vocabulary, end_id, width)
        for batch in batches:
            words = encoder(tokenizer, end_id)
            for part, texts in slices(batch, "text"):
                ids, lengths = words.encode(texts)
                ends = np.cumsum(lengths)
                starts = ends - lengths
                least = [np.minimum.reduceat(rank[ids], starts).astype(np.int64) for rank in ranks]
                raw = ids.astype(width).tobytes()
                yield as_batch(
                    _TOKENS,
                    {
                        "doc_id": part.column(0),
                        "copy": part.column(1),
                        "ids": [raw[size * a : size * b] for a, b in zip(starts.tolist(), ends.tolist())],
                        "near": least[0],
                        "near_too": least[1],
                    },
                )

    return run


def term_counts(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, id, occurrences) of every distinct id of every document, in order of document and id."""
    owner = np.repeat(np.arange(len(docs), dtype=np.int64), [len(d) for d in docs])
    pairs = np.sort(owner << 32 | np.concatenate(docs).astype(np.int64))
    first = np.flatnonzero(np.diff(pairs, prepend=-1))
    counts = np.diff(first, append=len(pairs))
    return pairs[first] >> 32, pairs[first] & 0xFFFFFFFF, counts


def _document_counts(width: str):
    """How many documents of this task hold each id: one row per id of the vocabulary at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                docs = [np.frombuffer(raw, width) for raw in batch.column(0).slice(at, 256).to_pylist()]
                here = np.bincount(term_counts(docs)[1], minlength=len(total))
                here[: len(total)] += total
                total = here
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["id", "docs"])

    return run


class Index:
    """BM25 over the documents of a shard, with idf and mean length of the whole corpus."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean_length: float):
        owner, terms, counts = term_counts(docs)
        self.terms = np.split(terms, np.searchsorted(owner, np.arange(1, len(docs))))
        lengths = np.array([len(d) for d in docs], np.float32)[owner]
        weight = idf[terms] * counts * (K1 + 1) / (counts + K1 * (1 - B + B * lengths / mean_length))
        order = np.argsort(terms, kind="stable")
        self.owner, self.weight = owner[order], weight[order]
        self.first = np.searchsorted(terms[order], np.arange(len(idf) + 1))
        self.count = len(docs)

    def scores(self, doc: int) -> np.ndarray:
        """Score of every document of the shard for the terms of ``doc``."""
        starts, ends = self.first[self.terms[doc]], self.first[self.terms[doc] + 1]
        sizes = ends - starts
        at = np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
        return np.bincount(self.owner[at], self.weight[at], self.count)


_PIECE_TYPE = [(n, pa.int64()) for n in ("doc_id", "copy", "start", "length", "doc_tokens", "offset")]
_SEQUENCES = pa.schema(
    [("sequence_id", pa.int64()), ("ids", pa.binary()), ("pieces", pa.list_(pa.struct(_PIECE_TYPE)))]
)
SEQUENCES_DDL = (
    "sequence_id bigint, ids binary, pieces array<struct<doc_id:bigint,copy:bigint,start:bigint,length:bigint,"
    "doc_tokens:bigint,offset:bigint>>"
)


class _Windows:
    """Sequences being filled one after the other; a document that does not fit goes on in the next."""

    def __init__(self, size: int):
        self.size, self.held, self.parts, self.pieces = size, 0, [], []
        self.done: list[tuple[bytes, list[dict]]] = []

    def put(self, name: tuple[int | None, int], ids: np.ndarray) -> bool:
        """Place a whole document; True if it began a new sequence on the way, or ended one."""
        start, closed = 0, False
        while start < len(ids):
            take = min(len(ids) - start, self.size - self.held)
            self.pieces.append(
                dict(doc_id=name[0], copy=name[1], start=start, length=take, doc_tokens=len(ids), offset=self.held)
            )
            self.parts.append(ids[start : start + take])
            start, self.held = start + take, self.held + take
            if self.held == self.size:
                self.close()
                closed = True
        return closed

    def close(self) -> None:
        if self.held:
            self.done.append((np.concatenate(self.parts).astype("<u4").tobytes(), self.pieces))
        self.held, self.parts, self.pieces = 0, [], []


def pack_shard(names: list, docs: list[np.ndarray], windows: _Windows, idf: np.ndarray, mean_length: float) -> None:
    """Fill windows: the first unused document seeds one, its best unused neighbours follow until it is full.

    A document cut at the end of a window goes on in the next one and is its seed.
    """
    index = Index(docs, idf, mean_length)
    unused = np.ones(len(docs), bool)
    seed = 0
    while unused.any():
        if unused[seed]:  # else it is the document that ran over from the window before
            unused[seed] = False
            windows.put(names[seed], docs[seed])
        scores = index.scores(seed)
        rest = np.flatnonzero(unused)
        for doc in rest[np.argsort(-scores[rest], kind="stable")].tolist():
            unused[doc] = False
            if windows.put(names[doc], docs[doc]):
                seed = doc if windows.held else int(np.argmax(unused))
                break


def _pack(window: int, idf: np.ndarray, mean_length: float, shard_ids: int, width: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = _Windows(window)
        names: list[tuple] = []
        docs: list[np.ndarray] = []
        held = made = part = 0

        def finished() -> Iterator[pa.RecordBatch]:
            nonlocal made
            for at in range(0, len(windows.done), 64):
                some = windows.done[at : at + 64]
                yield as_batch(
                    _SEQUENCES,
                    {
                        "sequence_id": [(part << 33) + made + i for i in range(len(some))],
                        "ids": [ids for ids, _ in some],
                        "pieces": [pieces for _, pieces in some],
                    },
                )
                made += len(some)
            windows.done = []

        for batch in batches:
            own = [batch.column(batch.schema.get_field_index(n)) for n in ("doc_id", "copy", "ids", "part")]
            for doc_id, copy, raw, part_ in zip(*own):
                part = part_.as_py()
                docs.append(np.frombuffer(raw.as_py(), width))
                names.append((doc_id.as_py(), copy.as_py()))
                held += len(docs[-1])
                if held >= shard_ids:
                    pack_shard(names, docs, windows, idf, mean_length)
                    names, docs, held = [], [], 0
                    yield from finished()
        if docs:
            pack_shard(names, docs, windows, idf, mean_length)
        windows.close()
        yield from finished()

    return run


def pack(
    docs: DataFrame,
    tokenizer: str,
    window: int = WINDOW,
    end_id: int = END,
    shard_ids: int = SHARD_IDS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Sequences of at most ``window`` ids: sequence_id, ids (little-endian 32 bit), pieces.

    Every document's ids, its end id included, lie in pieces that follow each other without a gap; a null text
    counts as empty and is an end id alone.  Rows of one id are packed one by one and told apart by ``copy``;
    null ids are allowed; an empty table gives no sequences; other columns are not read.

    Documents are dealt out by ranges of two least hashes over their ids, so that those with much in common
    tend to meet.  A task cuts its range into shards of about ``shard_ids`` ids, each with an inverted index,
    and packs them one after the other into the same run of windows: only its last one may stay short.  Inverse
    document frequencies (one number per id of the vocabulary) and the mean length are those of all documents.
    """
    rows = docs.select(
        column(id_column).cast("long").alias("doc_id"),
        F.monotonically_increasing_id().alias("copy"),
        column(text_column).cast("string").alias("text"),
    )
    # Two bytes an id where the vocabulary allows it, on the way and in memory.
    from tokenizers import Tokenizer

    vocabulary = max(Tokenizer.from_file(tokenizer).get_vocab_size(), end_id + 1)
    width = "<u2" if vocabulary <= 1 << 16 else "<u4"
    tokens = written(
        rows.mapInArrow(
            _tokenize(tokenizer, end_id, vocabulary, width),
            "doc_id bigint, copy bigint, ids binary, near bigint, near_too bigint",
        )
    )
    total = tokens.agg(F.count(F.lit(1)).alias("docs"), (F.sum(F.octet_length("ids")) / np.dtype(width).itemsize).alias("ids")).first()
    if not total.docs:
        return docs.sparkSession.createDataFrame([], SEQUENCES_DDL)
    counts = tokens.select("ids").mapInArrow(_document_counts(width), "id bigint, docs bigint")
    counts = counts.groupBy("id").agg(F.sum("docs").alias("docs"))
    # At most one row per id of the vocabulary, however many documents there are.
    frequency = counts.toPandas()
    with_id = np.zeros(int(frequency["id"].max()) + 1)
    with_id[frequency["id"].to_numpy()] = frequency["docs"].to_numpy()
    idf = np.log1p((total.docs - with_id + 0.5) / (with_id + 0.5)).astype(np.float32)
    order = ["near", "near_too", "doc_id", "copy"]
    ranged = tokens.repartitionByRange(*order).sortWithinPartitions(*order)
    return ranged.select("doc_id", "copy", "ids", F.spark_partition_id().alias("part")).mapInArrow(
        _pack(window, idf, total.ids / total.docs, shard_ids, width), SEQUENCES_DDL
    )


def pieces(sequences: DataFrame) -> DataFrame:
    """One row per piece, with the checksum of its ids as they stand in the sequence."""
    return sequences.select("sequence_id", "ids", F.explode("pieces").alias("p")).select(
        F.col("p.doc_id").alias("doc_id"),
        F.col("p.start").alias("start"),
        F.col("p.length").alias("length"),
        F.crc32(
            F.substring("ids", (F.col("p.offset") * 4 + 1).cast("int"), (F.col("p.length") * 4).cast("int"))
        ).alias("ids_crc32"),
        F.col("p.doc_tokens").alias("doc_tokens"),
        "sequence_id",
        F.col("p.offset").alias("offset"),
        F.col("p.copy").alias("copy"),
    )
