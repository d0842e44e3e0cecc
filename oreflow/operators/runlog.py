"""The run log: appended events, and the questions asked of them.

An event states what became known about one step (run, layer, step) at one time.  Nothing is
updated in place, so a failed run cannot roll back its own record; the current state of a step
is the latest known value of each attribute.
"""

from __future__ import annotations

import datetime
import uuid
from urllib.parse import unquote

import pyarrow as pa
from pyspark.errors import AnalysisException, ParseException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from oreflow.functions.values import elapsed_ms
from oreflow.operators.checks import ValidationFailed
from oreflow.schemas import RUN_EVENTS
from oreflow.session import delete_folder

STARTED, SUCCESS, FAILED = "STARTED", "SUCCESS", "FAILED"
STEP = ["run_id", "layer", "step"]
KNOWN = [f.name for f in RUN_EVENTS if f.name not in (*STEP, "event_time")]

INFRASTRUCTURE, INGESTION, DATA_QUALITY, CODE, OTHER = "INFRASTRUCTURE", "INGESTION", "DATA QUALITY", "CODE", "OTHER"

# Database error numbers by class.
INGESTION_NUMBERS = (4800, 4899)
DATA_QUALITY_NUMBERS = (2627, 2601, 547, 515, 8152, 8114, 8115, 241, 242, 245, 8169)
CODE_NUMBERS = (208, 207, 102, 201, 2812, 8144)
INFRASTRUCTURE_SEVERITY = 17

# Spark error conditions (the start of their names) by the same classes.
CONDITIONS = {
    INGESTION: ("PATH_NOT_FOUND", "FAILED_READ_FILE", "MALFORMED", "UNABLE_TO_INFER_SCHEMA", "CANNOT_READ"),
    DATA_QUALITY: (
        "CAST_", "NUMERIC_VALUE_OUT_OF_RANGE", "ARITHMETIC_OVERFLOW", "DIVIDE_BY_ZERO", "CANNOT_PARSE",
        "NOT_NULL_ASSERT_VIOLATION", "EXCEED_LIMIT_LENGTH", "DUPLICATED_",
    ),
    CODE: (
        "UNRESOLVED_", "TABLE_OR_VIEW_NOT_FOUND", "DATATYPE_MISMATCH", "PARSE_SYNTAX_ERROR", "AMBIGUOUS_",
        "WRONG_NUM_ARGS", "MISSING_",
    ),
    INFRASTRUCTURE: ("UNABLE_TO_ACQUIRE_MEMORY", "TASK_WRITE_FAILED", "OUT_OF_MEMORY"),
}


def error_class(severity: Column, number: Column) -> Column:
    """Class of a database error; the first matching rule wins."""
    return (
        F.when(severity >= INFRASTRUCTURE_SEVERITY, F.lit(INFRASTRUCTURE))
        .when(number.between(*INGESTION_NUMBERS), F.lit(INGESTION))
        .when(number.isin(*DATA_QUALITY_NUMBERS), F.lit(DATA_QUALITY))
        .when(number.isin(*CODE_NUMBERS), F.lit(CODE))
        .otherwise(F.lit(OTHER))
    )


def exception_class(error: BaseException) -> str:
    """The same classes for an exception raised by a Spark job."""
    if isinstance(error, ValidationFailed):
        return DATA_QUALITY
    if isinstance(error, (MemoryError, ConnectionError)):
        return INFRASTRUCTURE
    if isinstance(error, PySparkException):
        condition = error.getCondition() or ""
        for label, starts in CONDITIONS.items():
            if condition.startswith(starts):
                return label
        if isinstance(error, (AnalysisException, ParseException)):
            return CODE
    return OTHER


def failure_message(step: Column, message: Column) -> Column:
    return F.concat(F.lit("Step failed: "), F.coalesce(step, F.lit("")), F.lit(" | "), F.coalesce(message, F.lit("")))


def now() -> datetime.datetime:
    return datetime.datetime.now(datetime.timezone.utc)


def append(spark: SparkSession, path: str, events: list[dict]) -> None:
    """Add events (dicts over the RUN_EVENTS columns) to the log; their time is now."""
    moment = now()
    rows = pa.Table.from_pylist([{"event_time": moment, **e} for e in events], to_arrow_schema(RUN_EVENTS))
    append_rows(spark.createDataFrame(rows, RUN_EVENTS).coalesce(1), path)


APPENDED, COMPACTED = "append-", "compact-"


def append_rows(events: DataFrame, path: str) -> None:
    """Add events, which state their time, to the log; columns that they lack are unknown.

    Every append has a folder of its own: two that ran in one folder would share its ``_temporary``, and the first
    to finish would delete what the other has not yet put in place.
    """
    known = [F.col(f.name) if f.name in events.columns else F.lit(None).alias(f.name) for f in RUN_EVENTS]
    rows = events.select(*[c.cast(f.dataType).alias(f.name) for c, f in zip(known, RUN_EVENTS)])
    rows.write.parquet(f"{path}/{APPENDED}{uuid.uuid4().hex}")


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_EVENTS).option("recursiveFileLookup", True).parquet(path)


def compact(spark: SparkSession, path: str) -> int:
    """Rewrite the log's files as few large ones; returns how many were replaced.

    Appends may go on meanwhile: exactly the files that were listed are read, and only these are deleted, after
    their events are in place again.  Whoever reads in between, or after a compaction that died, meets
    events twice, which changes no state; the next compaction keeps one of each.  A reader that has
    listed a file before it is deleted fails rather than miss it, as does a second compaction of the same files.
    """
    listed = read(spark, path)
    files = listed.inputFiles()
    if len(files) < 2:
        return 0
    listed.distinct().write.parquet(f"{path}/{COMPACTED}{uuid.uuid4().hex}")
    for file in files:
        delete_folder(spark, unquote(file))
    # What an append has left besides; a compaction's folder may still be filling up.
    folders = {unquote(file).rpartition("/")[0] for file in files}
    for folder in folders:
        if folder.rpartition("/")[2].startswith(APPENDED) and read(spark, folder).inputFiles() == []:
            delete_folder(spark, folder)
    return len(files)


def current_state(events: DataFrame) -> DataFrame:
    """One row per step: the latest known value of every attribute, with the run time in ms.

    Each attribute is one map-side combined aggregate, so a step with very many events
    costs a row per task.  Of values known at the same moment the largest is taken.
    """

    def latest(name: str) -> Column:
        known = F.when(F.col(name).isNotNull(), F.struct("event_time", name))
        return F.max(known)[name].alias(name)

    state = events.groupBy(*STEP).agg(*[latest(c) for c in events.columns if c in KNOWN])
    return state.withColumn("run_time_ms", elapsed_ms(F.col("started_at"), F.col("ended_at")))


def batch_starts(state: DataFrame) -> DataFrame:
    """When each run began: the earliest start of its steps, over all layers."""
    return state.groupBy("run_id").agg(F.min("started_at").alias("batch_start"))


def latest_run(state: DataFrame, layer: str) -> DataFrame:
    """The layer's steps of the newest run, in order of their start.

    The newest run is the newest over all layers: where it has not reached this layer yet,
    there are no rows.
    """
    starts = batch_starts(state)
    newest = starts.agg(F.max("batch_start")).scalar()
    # Usually one run, so its own exchange: AQE then sees the true size and broadcasts it if
    # that is small, which also keeps a run with very many steps out of a single task.
    runs = starts.where(F.col("batch_start") == newest).repartition("run_id")
    return state.where(F.col("layer") == layer).join(runs, "run_id").orderBy("started_at")


def unfinished(steps: DataFrame) -> DataFrame:
    """Steps that did not end in success."""
    return steps.where(F.col("status") != SUCCESS)
