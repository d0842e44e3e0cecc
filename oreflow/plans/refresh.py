"""The full refresh: files to bronze, silver and gold, each layer checked before the next."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.operators import checks, runlog
from oreflow.operators.reconcile import MATCH, reconcile, row_count
from oreflow.plans import gold, silver
from oreflow.schemas import BRONZE, GOLD, SILVER, Layer
from oreflow.session import sized
from oreflow.sources import delimited
from oreflow.sources.tables import Warehouse


# The check that a source line has as many fields as its table has columns.
MALFORMED = "malformed_lines"


class LoadFailed(Exception):
    """A layer has steps that did not end in success, or has none at all."""


@dataclass(frozen=True)
class Load:
    """How to build a table; ``rows_read`` is the input whose rows the run log states."""

    build: Callable[[], DataFrame]
    rows_read: DataFrame | None = None
    cluster_by: list[str] | None = None


@dataclass(frozen=True)
class Refresh:
    """One run over a warehouse."""

    warehouse: Warehouse
    run_id: str

    @classmethod
    def start(cls, warehouse: Warehouse) -> Refresh:
        return cls(warehouse, f"run-{uuid.uuid4().hex}")

    @classmethod
    def resume(cls, warehouse: Warehouse, layer: str) -> Refresh:
        """Take up the newest run, which must have loaded ``layer``."""
        steps = runlog.latest_run(Refresh(warehouse, "").state(), layer).select("run_id").take(1)
        if not steps:
            raise LoadFailed(f"the newest run has no {layer} steps")
        return cls(warehouse, steps[0]["run_id"])

    # -- run log ---------------------------------------------------------------------------

    @property
    def log_path(self) -> str:
        return f"{self.warehouse.root}/admin/run_events"

    def state(self) -> DataFrame:
        return runlog.current_state(runlog.read(self.warehouse.spark, self.log_path))

    def log(self, layer: str, *events: dict) -> None:
        rows = [{"run_id": self.run_id, "layer": layer, **e} for e in events]
        runlog.append(self.warehouse.spark, self.log_path, rows)

    def load(self, layer: Layer, loads: Mapping[str, Load]) -> None:
        """Load independent tables together, so that their stages fill the cluster.

        Two appends to the run log: STARTED for all before, SUCCESS or FAILED for each after.  One that fails
        does not stop the others; the first failure is raised once all have ended.
        """
        if not loads:
            return
        began = runlog.now()
        names = {table: f"{layer.name}.load_{table}" for table in loads}
        self.log(layer.name, *[{"step": n, "started_at": began, "status": runlog.STARTED} for n in names.values()])
        with ThreadPoolExecutor(len(loads)) as pool:
            ended = list(pool.map(lambda table: self._load(layer, table, loads[table]), loads))
        self.log(layer.name, *[{"step": name, **event} for name, (event, _) in zip(names.values(), ended)])
        for _, error in ended:
            if error:
                raise error

    def _load(self, layer: Layer, table: str, load: Load) -> tuple[dict, Exception | None]:
        """What became known of one step, and its error if it failed.

        Row counts come from the written files' footers: exact also after retried tasks.
        """
        began = runlog.now()
        try:
            written = self.warehouse.write(layer, table, load.build(), self.run_id, load.cluster_by)
            counts = {}
            if load.rows_read is not None:
                counts = {"rows_read": load.rows_read.count(), "rows_written": written.count()}
        except Exception as error:
            known = {
                "status": runlog.FAILED,
                "error_class": runlog.exception_class(error),
                "error_message": f"Step failed: {layer.name}.load_{table} | {error}",
            }
            return {"started_at": began, "ended_at": runlog.now(), **known}, error
        return {"started_at": began, "ended_at": runlog.now(), "status": runlog.SUCCESS, **counts}, None

    def expect_loaded(self, layer: Layer) -> None:
        """Every table of the layer must have a successful step in this run; no rows is a failure too."""
        steps = self.state().where((F.col("run_id") == self.run_id) & (F.col("layer") == layer.name))
        found = {r["step"]: r["status"] for r in steps.select("step", "status").collect()}
        bad = [t for t in layer.tables if found.get(f"{layer.name}.load_{t}") != runlog.SUCCESS]
        if bad:
            raise LoadFailed(f"{layer.name}: {bad}")

    # -- bronze ----------------------------------------------------------------------------

    def load_bronze(self, source: str) -> None:
        """Load the tables the source has files for; ``expect_loaded`` misses the others."""
        spark = self.warehouse.spark
        found = delimited.tables_found(spark, source)
        self.load(
            BRONZE,
            {
                table: Load(lambda t=table, s=schema: delimited.read_delimited(spark, found[t], s))
                for table, schema in BRONZE.tables.items()
                if table in found
            },
        )

    def check_bronze(self, source: str) -> None:
        """Lines in the files against rows in the tables, fields per line, and text within its declared width.

        The scan pads short lines and cuts long ones, so one malformed line fails the layer.
        """
        spark = self.warehouse.spark
        tables = self.warehouse.read_layer(BRONZE, self.run_id)
        fields = {name: len(schema) for name, schema in BRONZE.tables.items()}
        counted = (
            delimited.source_line_counts(spark, source, fields=fields)
            .groupBy("table")
            .agg(F.sum("rows").alias("rows"), F.sum("malformed").alias("malformed"))
        )
        lines = spark.createDataFrame(counted.toArrow(), counted.schema)
        loaded = reduce(DataFrame.union, [row_count(df, name) for name, df in tables.items()])
        compared = reconcile(lines, loaded, ["table"], F.col("rows"), F.col("rows")).collect()
        report = self._report(BRONZE)
        failed = [
            {"check": r["outcome"], "table": r["table"], "columns": f"{r['left_rows']} != {r['right_rows']}"}
            for r in compared
            if r["outcome"] != MATCH
        ]
        failed += [
            {"check": MALFORMED, "table": r["table"], "columns": str(r["malformed"])}
            for r in lines.where("malformed > 0").orderBy("table").collect()
        ]
        bad = {f["table"] for f in failed} | {r["table"] for r in report.where(F.col("violations") > 0).collect()}
        self.log(
            "bronze",
            *[
                {
                    "step": f"bronze.load_{r['table']}",
                    "rows_read": r["left_rows"],
                    "rows_written": r["right_rows"],
                    "validation_status": runlog.FAILED if r["table"] in bad else runlog.SUCCESS,
                }
                for r in compared
            ],
        )
        if failed:
            raise checks.ValidationFailed("bronze", failed)
        checks.gate("bronze", report)

    # -- silver ----------------------------------------------------------------------------

    def load_silver(self) -> None:
        raw = self.warehouse.read_layer(BRONZE, self.run_id)
        self.load(
            SILVER, {table: Load(lambda c=clean, r=raw[table]: c(r), raw[table]) for table, clean in silver.TABLES.items()}
        )

    def check_silver(self) -> None:
        report = self._report(SILVER)
        statuses = checks.status_per_table(report).collect()
        self.log("silver", *[{"step": f"silver.load_{r['table']}", **_without_table(r)} for r in statuses])
        checks.gate("silver", report)

    # -- gold ------------------------------------------------------------------------------

    def load_gold(self) -> None:
        tables = self.warehouse.read_layer(SILVER, self.run_id)
        self.load(
            GOLD,
            {
                "dim_customer": Load(lambda: gold.dim_customer(gold.stored(tables)), tables["crm_cust_info"]),
                "dim_product": Load(lambda: gold.dim_product(gold.stored(tables)), tables["crm_prd_info"]),
            },
        )
        products, lines = self.warehouse.read(GOLD, "dim_product", self.run_id), tables["crm_sales_details"]
        facts = Load(
            lambda: gold.fact_sales({**tables, "crm_sales_details": sized(lines)}, sized(products)), lines, ["order_number"]
        )
        self.load(GOLD, {"fact_sales": facts})

    def check_gold(self) -> dict:
        """Run the gold checks; returns the share of flagged rows per flag."""
        report = self._report(GOLD)
        statuses = checks.status_for_layer(report).collect()
        self.log("gold", *[{"step": f"gold.load_{r['table']}", **_without_table(r)} for r in statuses])
        checks.gate("gold", report)
        fact = self.warehouse.read(GOLD, "fact_sales", self.run_id)
        return checks.flag_rates(fact, gold.FLAGS).first().asDict()

    def _report(self, layer: Layer) -> DataFrame:
        """The layer's checks, run once; one row per declared check."""
        report = checks.constraint_report(layer, self.warehouse.read_layer(layer, self.run_id))
        return self.warehouse.spark.createDataFrame(report.toArrow(), report.schema)


def _without_table(row) -> dict:
    return {k: v for k, v in row.asDict().items() if k != "table"}


def refresh_all(warehouse: Warehouse, source: str) -> tuple[str, dict]:
    """Load and check all layers, stopping at the first failure; publish what passed.

    Returns the run id and the flag rates of the new fact table.
    """
    run = Refresh.start(warehouse)
    run.load_bronze(source)
    run.expect_loaded(BRONZE)
    run.check_bronze(source)
    warehouse.publish(BRONZE, run.run_id)
    run.load_silver()
    run.expect_loaded(SILVER)
    run.check_silver()
    warehouse.publish(SILVER, run.run_id)
    run.load_gold()
    run.expect_loaded(GOLD)
    rates = run.check_gold()
    warehouse.publish(GOLD, run.run_id)
    return run.run_id, rates
