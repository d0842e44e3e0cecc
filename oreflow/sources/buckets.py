"""Tables kept in buckets of keys, of which a change rewrites only the touched ones."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from oreflow.session import delete_folder, written
from oreflow.sources.tables import conform

BUCKETS = 64
BUCKET = "_bucket"

# A bucket in more files than this, of less than this many bytes on average, is put together when it is next touched.
MOST_FILES = 8
SMALL_FILE = 16 << 20


@dataclass(frozen=True)
class BucketTable:
    """A Parquet table below ``path`` with one folder per bucket of ``key``, an expression of its columns."""

    spark: SparkSession
    path: str
    schema: StructType
    key: Callable[[], Column]
    buckets: int = BUCKETS

    def bucket(self, key: Column) -> Column:
        """The bucket of a key; NULL keys share one."""
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def _with_bucket(self) -> DataFrame:
        schema = StructType([*self.schema.fields, StructField(BUCKET, IntegerType())])
        return self.spark.read.schema(schema).parquet(self.path)

    def read(self) -> DataFrame:
        return self._with_bucket().drop(BUCKET)

    def _placed(self, rows: DataFrame) -> DataFrame:
        """The rows with their bucket, met in tasks of one bucket each, or several for a large one."""
        placed = conform(rows, self.schema).withColumn(BUCKET, self.bucket(self.key()))
        return placed.hint("rebalance", F.col(BUCKET))

    def _write(self, placed: DataFrame, mode: str) -> None:
        placed.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(BUCKET).parquet(self.path)

    def create(self, rows: DataFrame) -> None:
        self._write(self._placed(rows), "static")

    def replace(self, keys: DataFrame, rows: DataFrame) -> list[int]:
        """Put ``rows``, all that the keys now have, in place of what they had; returns the touched buckets.

        ``keys`` is a written table with the column ``key``.  Rows of other keys in touched buckets are copied from
        file to file, without a shuffle unless their bucket lies in many small files by then; other buckets
        are not written.  Running it again changes nothing, so a run that dies between two tables can be repeated.
        """
        touched = sorted(r[0] for r in keys.select(self.bucket(F.col("key"))).distinct().collect())  # at most ``buckets``
        if not touched:
            return []
        same = self.key().eqNullSafe(F.col("key"))
        table = self._with_bucket().where(F.col(BUCKET).isin(touched))
        kept = table.join(keys.select("key"), same, "left_anti")
        fresh = written(conform(rows, self.schema))
        held = self._files(table.select("*", "_metadata").join(keys.select("key"), same, "left_anti"))
        crowded = [b for b, (files, size) in held.items() if files > MOST_FILES and size < files * SMALL_FILE]
        in_crowded = F.col(BUCKET).isin(crowded)
        moved = self._placed(kept.where(in_crowded).drop(BUCKET).unionByName(fresh))
        left = {*held, *(r[0] for r in fresh.select(self.bucket(self.key())).distinct().collect())}
        if left:
            # Spark stages the new files and removes the old ones when all are there, so the table may read itself.
            self._write(kept.where(~in_crowded).select(*moved.columns).unionAll(moved), "dynamic")
        # Overwriting by partition leaves alone the folders that no row goes to.
        for bucket in set(touched) - left:
            delete_folder(self.spark, f"{self.path}/{BUCKET}={bucket}")
        return touched

    def _files(self, rows: DataFrame) -> dict[int, tuple[int, int]]:
        """Per bucket that has rows left: the files they lie in, and the size of these."""
        files = rows.groupBy(BUCKET, F.col("_metadata.file_path").alias("file")).agg(F.max("_metadata.file_size").alias("size"))
        found = files.groupBy(BUCKET).agg(F.count("file"), F.sum("size")).collect()  # at most ``buckets``
        return {bucket: (count, size) for bucket, count, size in found}
