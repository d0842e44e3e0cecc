"""Typed tables on shared storage: conform, full refresh, listing, publishing."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from oreflow.session import delete_folder, written


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """The schema's columns, in its order and types.  A value that does not fit its type raises."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata) for f in schema])


def reload(
    df: DataFrame, schema: StructType, path: str, cluster_by: list[str] | None = None, files: int | None = None
) -> None:
    """Replace the table at ``path`` with ``df``: same input, same table, however often it runs.

    ``cluster_by`` gives every file a range of these columns of its own and sorts inside it.  Boundaries are
    sampled from a written copy, so ``df`` is evaluated once; rows of one key may lie in two neighbouring files, so a
    hot key makes no large one.  ``files`` says how many there are, at most; else Spark goes by their size.
    """
    rows = conform(df, schema)
    if cluster_by:
        spread = F.xxhash64(*schema.names).alias("_spread")
        ranges = [*([files] if files else []), *cluster_by, "_spread"]
        rows = written(rows.select("*", spread)).repartitionByRange(*ranges).sortWithinPartitions(*cluster_by).drop("_spread")
    rows.write.mode("overwrite").parquet(path)


def file_ranges(table: DataFrame, column: str) -> DataFrame:
    """(file, rows, first, last, before) of a table read from files: the range of ``column`` in each, and the largest
    value in the files ahead of it in that order.  Files overlap where ``first`` is less than ``before``.
    """
    files = table.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("rows"), F.min(column).alias("first"), F.max(column).alias("last")
    )
    # One row a file.
    ahead = Window.orderBy("first", "last", "file").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("before", F.max("last").over(ahead))


NO_RUN = "none"
ADMIN = "admin"


@dataclass(frozen=True)
class Warehouse:
    """Layers of Parquet tables under one root, each run in its own folder.

    A run writes next to the published one and never over it.  A layer's views read the run that the layer's
    pointer names; ``publish`` moves the pointer after the checks have passed, so readers change over to all
    tables of a run at once.
    """

    spark: SparkSession
    root: str

    def path(self, layer: str, table: str, run_id: str) -> str:
        return f"{self.root}/{layer}/{table}/run_id={run_id}"

    def write(self, layer, name: str, df: DataFrame, run_id: str, cluster_by: list[str] | None = None) -> DataFrame:
        reload(df, layer.tables[name], self.path(layer.name, name, run_id), cluster_by)
        return self.read(layer, name, run_id)

    def read(self, layer, name: str, run_id: str) -> DataFrame:
        return self.spark.read.schema(layer.tables[name]).parquet(self.path(layer.name, name, run_id))

    def read_layer(self, layer, run_id: str) -> dict[str, DataFrame]:
        return {name: self.read(layer, name, run_id) for name in layer.tables}

    def create_if_absent(self, layer) -> None:
        """Register the layer's database, its pointer and any table it lacks, empty but typed."""
        for name, schema in layer.tables.items():
            empty = self.spark.createDataFrame([], schema).write.mode("ignore")
            empty.parquet(self.path(layer.name, name, NO_RUN))
        self._register(layer)

    def _register(self, layer) -> None:
        """The layer's views; their text depends on the root only, so replacing them changes nothing for readers.

        Run ids must not look like numbers, or Spark would take the folders' names for such.
        """
        for database in (ADMIN, layer.name):
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        if self.current(layer) is None:
            self._point(layer, NO_RUN, NO_RUN)
        for name, schema in layer.tables.items():
            columns = ", ".join(schema.names)
            self.spark.sql(
                f"CREATE OR REPLACE VIEW {layer.name}.{name} AS SELECT {columns} FROM parquet.`{self.root}/{layer.name}/{name}`"
                f" WHERE run_id = (SELECT run_id FROM {self._pointer(layer)})"
            )

    def publish(self, layer, run_id: str) -> None:
        """Let the layer's views read ``run_id``.

        The run published before stays for readers that have begun with it; the one before that is deleted.
        Runs that were never published are left alone: they may be under way, or wanted for a look.
        """
        self._register(layer)
        now = self.current(layer)
        if now.run_id == run_id:
            return
        if now.previous not in (NO_RUN, run_id):
            self.discard(layer, now.previous)
        self._point(layer, run_id, now.run_id)

    def current(self, layer) -> Row | None:
        """The published run of the layer and the one before it; None if this root has none."""
        if not self.spark.catalog.tableExists(self._pointer(layer)):
            return None
        now = self.spark.table(self._pointer(layer)).first()
        return now if now.root == self.root else None

    def discard(self, layer, run_id: str) -> None:
        """Delete what a run has written for the layer."""
        for name in layer.tables:
            delete_folder(self.spark, self.path(layer.name, name, run_id))

    def _pointer(self, layer) -> str:
        return f"{ADMIN}.current_{layer.name}"

    def _point(self, layer, run_id: str, previous: str) -> None:
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self._pointer(layer)} AS"
            f" SELECT '{run_id}' AS run_id, '{previous}' AS previous, '{self.root}' AS root"
        )

    def listed(self, layer: str) -> list[str]:
        """Names of the tables a layer offers."""
        return sorted(t.name for t in self.spark.catalog.listTables(layer))
