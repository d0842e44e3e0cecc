"""Delimited text sources: scan, discovery, line counts, report sink."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from oreflow.operators.profile import profile

BAD_LINE = "_bad_line"


def _scan(spark: SparkSession, encoding: str):
    # No quoting: a quote is data.  LF ends a row, so the CR of a CRLF file stays on the last field.
    return spark.read.options(
        header=True, sep=",", lineSep="\n", quote="", encoding=encoding, enforceSchema=True
    )


def read_delimited(spark: SparkSession, path: str | list[str], schema: StructType, encoding="UTF-8") -> DataFrame:
    """All-text scan by position behind one header line; an empty field is NULL, blanks are kept."""
    return _scan(spark, encoding).schema(schema).csv(path)


def bad_lines(spark: SparkSession, path: str | list[str], schema: StructType, encoding="UTF-8") -> DataFrame:
    """The lines with too few or too many fields, as text in ``_bad_line``.

    The scan itself keeps such rows (short ones filled with NULL, long ones cut).
    """
    checked = StructType([*schema, StructField(BAD_LINE, StringType())])
    rows = (
        _scan(spark, encoding)
        .schema(checked)
        .option("columnNameOfCorruptRecord", BAD_LINE)
        .csv(path)
    )
    return rows.where(F.col(BAD_LINE).isNotNull())


def table_name(file_path: Column) -> Column:
    """``../<prefix>_crm/Cust_Info.csv`` -> ``crm_cust_info``: folder after its first ``_``, lower-case stem.

    A folder named like a file that holds part files, ``Cust_Info.csv/part-0.csv``, counts as that file.
    """
    parts = F.split(_whole_file(file_path), "/")
    folder = F.regexp_replace(F.element_at(parts, -2), "^[^_]*_", "")
    stem = F.regexp_replace(F.element_at(parts, -1), "[.][^.]*$", "")
    return F.concat(folder, F.lit("_"), F.lower(stem))


def _whole_file(file_path: Column) -> Column:
    return F.regexp_replace(file_path, "([.][^./]+)/part-[^/]*$", "$1")


def _decoded(file_path: Column) -> Column:
    """A path as it is on disk, from the percent-encoded form that Spark gives, which may leave out an empty host."""
    path = F.url_decode(F.replace(file_path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(path, "^([^:/]+):///", "$1:/")


def _file_path() -> Column:
    return _decoded(F.col("_metadata.file_path")).alias("file_path")


def discover(spark: SparkSession, root: str, pattern: str = "*.csv") -> DataFrame:
    """Every matching file below ``root`` with its length and table name; contents are not read.

    Spark's scans leave out files of zero bytes, but its file index names them: they are listed with length 0.
    """
    files = (
        spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter=pattern).load(root)
    )
    scanned = files.select(_file_path(), F.col("length"))
    indexed = spark.createDataFrame(pa.table({"_encoded": pa.array(files.inputFiles(), pa.string())}))
    named = indexed.select(_decoded(F.col("_encoded")).alias("file_path"))
    return (
        named.join(scanned, "file_path", "left")
        .withColumn("length", F.coalesce("length", F.lit(0).cast("bigint")))
        .withColumn("table", table_name(F.col("file_path")))
    )


def source_line_counts(
    spark: SparkSession, root: str, pattern: str = "*.csv", fields: Mapping[str, int] | None = None
) -> DataFrame:
    """Lines per file without the header, as (file_path, table, rows, malformed); a file of zero bytes has none.

    Counts raw lines, blank and malformed ones included, so it also catches what a parser
    skips.  Large files are counted split by split.  ``malformed`` are the blank lines and those that do not
    have as many fields as ``fields`` says for the table; it is NULL for tables not named there.
    """
    width = F.length("value") - F.length(F.replace("value", F.lit(","), F.lit(""))) + 1
    lines = (
        spark.read.options(lineSep="\n", recursiveFileLookup=True, pathGlobFilter=pattern)
        .text(root)
        .groupBy(
            F.col("_metadata.file_path").alias("_encoded"),
            F.when(F.btrim("value", F.lit(" \t\r")) != "", width).otherwise(0).alias("_width"),
        )
        .agg(F.count(F.lit(1)).alias("_lines"))
    )
    # From here on there is one row per file and width, so names are worked out on few rows.
    named = lines.select(_decoded(F.col("_encoded")).alias("file_path"), "_width", "_lines").withColumn(
        "table", table_name(F.col("file_path"))
    )
    expected = F.lit(None).cast("int")
    for table, count in (fields or {}).items():
        expected = F.when(F.col("table") == table, count).otherwise(expected)
    wrong = F.when(expected.isNotNull(), F.when(F.col("_width") != expected, F.col("_lines")).otherwise(0))
    counted = named.groupBy("file_path", "table").agg(
        (F.sum("_lines") - 1).alias("rows"), F.sum(wrong).cast("bigint").alias("malformed")
    )
    none = F.lit(0).cast("bigint")
    empty = (
        discover(spark, root, pattern)
        .where("length = 0")
        .select("file_path", "table", none.alias("rows"), F.when(expected.isNotNull(), none).alias("malformed"))
    )
    return counted.unionByName(empty)


def tables_found(
    spark: SparkSession, root: str, pattern: str = "*.csv", with_content: bool = False
) -> dict[str, list[str]]:
    """The tables below ``root``, each with one path pattern per folder that has it.

    ``with_content`` leaves out tables all of whose files are of zero bytes.

    Reading by pattern leaves the listing of files to Spark; filtering rows by their file's name
    would evaluate the naming rule once per row.  Part files count as the folder that holds them.
    """
    whole = _whole_file(F.col("file_path"))
    files = discover(spark, root, pattern)
    if with_content:
        files = files.where("length > 0")
    found = (
        files.select(
            "table",
            (whole != F.col("file_path")).alias("in_parts"),
            F.regexp_extract(whole, "^(.*)/([^/]*)$", 1).alias("folder"),
            F.lower(F.regexp_extract(whole, "^(.*)/([^/]*)$", 2)).alias("file"),
        )
        .distinct()
        .orderBy("table", "folder", "file", "in_parts")
        .collect()
    )
    tables: dict[str, list[str]] = {}
    for r in found:
        path = f"{_literal(r['folder'])}/{_any_case(r['file'])}"
        tables.setdefault(r["table"], []).append(f"{path}/part-*" if r["in_parts"] else path)
    return tables


def _literal(name: str) -> str:
    """``name`` as a path pattern that matches nothing else."""
    return "".join(f"\\{c}" if c in "\\*?[]{},^-" else c for c in name)


def _any_case(name: str) -> str:
    """The pattern of a lower-case file name in any case; letters without a single capital match themselves."""
    return "".join(f"[{c}{c.upper()}]" if len(c.upper()) == 1 and c.upper() != c else _literal(c) for c in name)


def profile_files(spark: SparkSession, root: str, pattern: str = "*.csv") -> DataFrame:
    """One row per table and column below ``root``.

    Unlike the raw scan this reads quotes and CRLF as the format means them, and takes the
    columns from the header.  Files of zero bytes have no columns to report.
    """
    reports = [
        profile(spark.read.option("header", True).csv(paths), table)
        for table, paths in tables_found(spark, root, pattern, with_content=True).items()
    ]
    if not reports:
        raise ValueError(f"no {pattern} below {root}")
    return reduce(DataFrame.union, reports)


def write_report(df: DataFrame, path: str) -> None:
    """Write as delimited text with a header line; blanks around a value are kept."""
    df.write.mode("overwrite").options(
        header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)
