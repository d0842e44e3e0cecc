"""Token ids on file as compressed bit or byte planes of fixed-size blocks, with a chunk index.

A store is a Parquet table of blocks, each a row that can be read by itself:

* ``part``, ``block``: the writing task's number and the block's number in it; ids run on from block to block
* ``start``, ``count``: ids of the part before the block, and in it
* ``kind``: ``byte`` or ``bit``; ``planes``: one zstandard frame per plane, lowest plane first
* ``docs``: the chunk index, for each piece of a document in the block ``doc_id``, ``ordinal`` (of the document in
  the part), ``first`` (ids of the document before the piece), ``at`` (ids of the block before it) and ``length``

Parts are in ascending order of doc_id, and so are the documents in a part.  A byte plane holds the k-th byte of
every id, a bit plane the k-th bit; planes above the highest id are left out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from oreflow.llm.common import as_batch, column, slices
from oreflow.llm.tokens import encoder

BLOCK_IDS = 1 << 16
LEVEL = 3

_DOCS = pa.list_(pa.struct([(n, pa.int64()) for n in ("doc_id", "ordinal", "first", "at", "length")]))
_BLOCKS = pa.schema(
    [
        ("part", pa.int32()),
        ("block", pa.int64()),
        ("start", pa.int64()),
        ("count", pa.int32()),
        ("kind", pa.string()),
        ("planes", pa.list_(pa.binary())),
        ("docs", _DOCS),
    ]
)
_BLOCKS_DDL = (
    "part int, block bigint, start bigint, count int, kind string, planes array<binary>,"
    " docs array<struct<doc_id:bigint,ordinal:bigint,first:bigint,at:bigint,length:bigint>>"
)


def to_planes(ids: np.ndarray, kind: str, level: int = LEVEL) -> list[bytes]:
    """Transpose ids into planes and compress each."""
    import zstandard

    octets = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4).T
    width = max(1, int(ids.max(initial=0)).bit_length())
    if kind == "byte":
        planes = octets[: -(-width // 8)]
    else:
        planes = [np.packbits((octets[k // 8] >> (k % 8)) & 1) for k in range(width)]
    packer = zstandard.ZstdCompressor(level=level)
    return [packer.compress(np.ascontiguousarray(p).tobytes()) for p in planes]


def from_planes(planes: list[bytes], kind: str, count: int) -> np.ndarray:
    import zstandard

    unpacker = zstandard.ZstdDecompressor()
    ids = np.zeros(count, np.uint32)
    for k, plane in enumerate(planes):
        raw = np.frombuffer(unpacker.decompress(plane), np.uint8)
        if kind == "byte":
            ids |= raw.astype(np.uint32) << np.uint32(8 * k)
        else:
            ids |= np.unpackbits(raw, count=count).astype(np.uint32) << np.uint32(k)
    return ids


def _write_blocks(tokenizer: str, end_id: int, kind: str, block_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[np.ndarray] = []  # ids not yet in a block
        index: list[dict] = []  # of the block being filled
        held = block = ordinal = 0
        part = 0

        def full(ids: np.ndarray) -> pa.RecordBatch:
            row = {
                "part": [part], "block": [block], "start": [block * block_ids], "count": [len(ids)],
                "kind": [kind], "planes": [to_planes(ids, kind)], "docs": [index],
            }
            return as_batch(_BLOCKS, row)

        for batch in batches:
            words = encoder(tokenizer, end_id)
            for piece, texts in slices(batch, "text"):
                part = piece.column(piece.schema.get_field_index("part"))[0].as_py()
                ids, lengths = words.encode(texts)
                at = 0
                for doc_id, length in zip(piece.column(0).to_pylist(), lengths.tolist()):
                    first = 0
                    while first < length:
                        take = min(length - first, block_ids - held)
                        index.append(
                            {"doc_id": doc_id, "ordinal": ordinal, "first": first, "at": held, "length": take}
                        )
                        pending.append(ids[at : at + take])
                        at, first, held = at + take, first + take, held + take
                        if held == block_ids:
                            yield full(np.concatenate(pending))
                            pending, index, held, block = [], [], 0, block + 1
                    ordinal += 1
        if held:
            yield full(np.concatenate(pending))

    return run


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = 2,
    kind: str = "byte",
    block_ids: int = BLOCK_IDS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> None:
    """Encode all texts, an end id after each, and write them to ``path`` in ascending order of id.

    A null text is encoded as an empty one.  Rows with a null id come first; rows of one id are in order of a
    hash of the text, and each keeps its own ids.  An empty table gives a store without blocks; other columns
    are not read.  Documents are dealt out by ranges of (id, hash), so equal ids do not meet in one task unless
    their texts are equal as well.
    """
    if kind not in ("byte", "bit"):
        raise ValueError(f"unknown kind of plane: {kind}")
    rows = docs.select(column(id_column).cast("long").alias("doc_id"), column(text_column).cast("string").alias("text"))
    order = ["doc_id", "hash"]
    ranged = rows.withColumn("hash", F.xxhash64("text")).repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = ranged.select("doc_id", "text", F.spark_partition_id().alias("part"))
    # Planes are compressed already.
    numbered.mapInArrow(_write_blocks(tokenizer, end_id, kind, block_ids), _BLOCKS_DDL).write.option(
        "compression", "uncompressed"
    ).parquet(path)


_PIECES = pa.schema(
    [(n, pa.int64()) for n in ("part", "ordinal", "doc_id", "first", "place", "length", "crc32")]
)


def _read_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = from_planes(row["planes"], row["kind"], row["count"]).astype("<u4")
            docs = row["docs"]
            yield as_batch(
                _PIECES,
                {
                    "part": [row["part"]] * len(docs),
                    "place": [row["start"] + d["at"] for d in docs],
                    "crc32": [zlib.crc32(ids[d["at"] : d["at"] + d["length"]]) for d in docs],
                    **{n: [d[n] for d in docs] for n in ("ordinal", "doc_id", "first", "length")},
                },
            )


def crc32_of_parts(parts: list[tuple[int, int]]) -> int:
    """The crc32 of parts laid end to end, from the (crc32, byte length) of each.

    Appending zero bytes is a linear map of the 32 bits of the state; its power for a length comes from squares.
    """
    out = 0
    for crc, length in parts:
        step = [0xEDB88320] + [1 << i for i in range(31)]  # one zero bit
        bits = length * 8
        while bits:
            if bits & 1:
                out = _times(step, out)
            step = [_times(step, x) for x in step]
            bits >>= 1
        out ^= crc
    return out


def _times(matrix: list[int], vector: int) -> int:
    out = 0
    for row in matrix:
        if vector & 1:
            out ^= row
        vector >>= 1
    return out


def _join_crcs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        joined = []
        for pieces in batch.column(batch.schema.get_field_index("pieces")).to_pylist():
            joined.append(
                pieces[0]["crc32"]
                if len(pieces) == 1
                else crc32_of_parts([(p["crc32"], 4 * p["length"]) for p in pieces])
            )
        names = [n for n in batch.schema.names if n != "pieces"]
        yield pa.RecordBatch.from_arrays(
            [batch.column(batch.schema.get_field_index(n)) for n in names] + [pa.array(joined, pa.int64())],
            names=[*names, "ids_crc32"],
        )


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Per document of a store, decoded from its blocks: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it.  Blocks decode independently and say where their pieces
    lie in the part; a document in several of them takes its checksum from those of its pieces.
    """
    blocks = spark.read.parquet(path)
    pieces = blocks.select("part", "start", "count", "kind", "planes", "docs").mapInArrow(
        _read_pieces, ", ".join(f"{n} bigint" for n in _PIECES.names)
    )
    docs = pieces.groupBy("part", "ordinal").agg(
        F.first("doc_id").alias("doc_id"),
        F.min("place").alias("place"),
        F.sum("length").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("first", "length", "crc32"))).alias("pieces"),
    )
    joined = docs.mapInArrow(
        _join_crcs, "part bigint, ordinal bigint, doc_id bigint, place bigint, n_tokens bigint, ids_crc32 bigint"
    )
    # One row per writing task: the ids of all parts before it.
    parts = blocks.groupBy(F.col("part").cast("long").alias("part")).agg(F.sum("count").alias("count"))
    before_part = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("count").over(before_part), F.lit(0)).alias("part_start"))
    return joined.join(parts, "part").select(
        "doc_id", (F.col("part_start") + F.col("place")).alias("start"), "n_tokens", "ids_crc32"
    )
