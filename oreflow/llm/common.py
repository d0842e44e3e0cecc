"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.session import tune

# Rows and bytes that Spark hands to Python at a time, whichever is reached first; a batch has one row at least.
ARROW_ROWS = 1000
ARROW_BYTES = 8 << 20
# What one step inside a task holds of texts at a time, whatever the batch size.
SLICE_BYTES = 2 << 20


def ready(spark: SparkSession) -> SparkSession:
    """Set what the operators rely on in a session someone else created."""
    tune(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    # Texts that one step has shuffled and written need not wait on disk for the driver's garbage collector.
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return spark


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    """A column by its exact name, dots and back-ticks included."""
    return F.col(quoted(name))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that clash with no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Cut a batch so that each piece holds about ``limit`` bytes of text; null texts count as empty."""
    values = batch.column(batch.schema.get_field_index(text)).cast(pa.binary())
    first, held, texts = 0, 0, []
    for i in range(batch.num_rows):
        value = values[i].as_py() or b""
        texts.append(value)
        held += len(value)
        if held >= limit:
            yield batch.slice(first, len(texts)), texts
            first, held, texts = i + 1, 0, []
    if texts:
        yield batch.slice(first, len(texts)), texts


def as_batch(schema: pa.Schema, columns: dict) -> pa.RecordBatch:
    """A record batch from lists or arrays by column name."""
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, field.type) for field in schema for c in [columns[field.name]]],
        schema=schema,
    )
