"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

# Settings the operators rely on.  forceOptimizeSkewedJoin lets AQE split a hot
# key even where a second join on the same key follows (customer dimension).
SQL_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to a session someone else created."""
    for name, value in SQL_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(app: str, cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        # Recording the Python call site of every Column costs more than planning does.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only where the session names none (local tests) is a temporary one made.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="oreflow-"))
    return spark.sparkContext.getCheckpointDir()


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there, on whatever store it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def scratch_folder(spark: SparkSession) -> str:
    """This application's own part of the shared folder."""
    return f"{shared_folder(spark)}/oreflow-{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application; results that still read them must be written before."""
    delete_folder(spark, scratch_folder(spark))


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where many small queries follow on one costly input: the copy is columnar,
    so each of them reads only its own columns, and it survives lost executors.  It stays until ``clear_scratch``.
    """
    spark = df.sparkSession
    path = f"{scratch_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sized(df: DataFrame) -> DataFrame:
    """``df``, read from files, as a side of joins that is broadcast only if its rows are small enough for it.

    By itself Spark goes by the bytes of the files, where a column of few values takes a bit or two a row.  The hash
    table of a broadcast holds whole rows, and the driver builds it: millions of them from files of a few MB.  Here
    the rows count, from the files' footers, against the session's own limit; what is larger is joined by a shuffle.
    """
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return df.hint("merge") if 0 <= limit < df.count() * row_bytes(df.schema) else df


def row_bytes(schema: StructType) -> int:
    """About what a row takes in memory: eight bytes for the NULLs and for each field, more for one without a fixed width."""
    wide = (StringType, BinaryType, ArrayType, MapType, StructType)
    return 8 + sum(8 + 16 * isinstance(f.dataType, wide) for f in schema)


def written_all(frames: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """``written`` for independent frames, submitted together so that their stages fill the cluster."""
    with ThreadPoolExecutor(len(frames)) as pool:
        return dict(zip(frames, pool.map(written, frames.values())))
