"""Data quality checks, generated from the contract, as one results DataFrame.

Each check yields rows (check, table, other_table, columns, violations).  Everything is
aggregated before it is shuffled or joined, so one key with very many rows costs one row per task.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from oreflow.functions.values import flag_rate
from oreflow.schemas import Layer, Reference, declared_widths

NULL_KEY, DUPLICATE_KEY, REFERENCE, WIDTH = "null_key", "duplicate_key", "reference", "width"


class ValidationFailed(Exception):
    """Some checks found violations; ``failed`` lists them."""

    def __init__(self, layer: str, failed: list[dict]):
        self.layer = layer
        self.failed = failed
        super().__init__(f"{layer}: " + "; ".join(f"{f['check']} {f['table']}({f['columns']})" for f in failed))


def _as_results(counts: DataFrame, check: str, table: str, other: str | None, columns: str) -> DataFrame:
    return counts.select(
        F.lit(check).alias("check"),
        F.lit(table).alias("table"),
        F.lit(other).cast("string").alias("other_table"),
        F.lit(columns).alias("columns"),
        F.col("violations").cast("bigint").alias("violations"),
    )


def row_checks(df: DataFrame, table: str, keys: Iterable[str] = (), widths: dict[str, int] | None = None) -> DataFrame:
    """Rows without a key value and texts beyond their width: all of a table's in one scan."""
    tests = [(NULL_KEY, k, F.col(k).isNull()) for k in keys]
    tests += [(WIDTH, c, F.length(c) > w) for c, w in (widths or {}).items()]
    counted = df.agg(*[F.count_if(broken).alias(f"_{i}") for i, (_, _, broken) in enumerate(tests)])
    results = [
        F.struct(
            F.lit(check).alias("check"),
            F.lit(table).alias("table"),
            F.lit(None).cast("string").alias("other_table"),
            F.lit(column).alias("columns"),
            F.col(f"_{i}").alias("violations"),
        )
        for i, (check, column, _) in enumerate(tests)
    ]
    return counted.select(F.inline(F.array(*results)))


def null_keys(df: DataFrame, table: str, keys: Iterable[str]) -> DataFrame:
    return row_checks(df, table, keys)


def width_check(df: DataFrame, table: str, schema: StructType) -> DataFrame:
    return row_checks(df, table, widths=declared_widths(schema))


def duplicate_keys(df: DataFrame, keys: list[str] | tuple[str, ...]) -> DataFrame:
    """The (composite) keys that occur more than once, with their number of rows; NULLs group together."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def duplicate_key_check(df: DataFrame, table: str, keys: tuple[str, ...]) -> DataFrame:
    counted = duplicate_keys(df, keys).agg(F.count(F.lit(1)).alias("violations"))
    return _as_results(counted, DUPLICATE_KEY, table, None, ",".join(keys))


def orphan_keys(source: DataFrame, target: DataFrame, ref: Reference) -> DataFrame:
    """Source key values missing in the target, with their number of rows.

    A NULL source key is an orphan unless the reference is optional.
    """
    keys = source.groupBy(F.col(ref.column).alias("key")).agg(F.count(F.lit(1)).alias("rows"))
    if ref.allow_null:
        keys = keys.where(F.col("key").isNotNull())
    known = target.select(F.col(ref.target_column).alias("known")).distinct()
    return keys.join(known, F.col("key") == F.col("known"), "left_anti")


def reference_check(source: DataFrame, target: DataFrame, ref: Reference) -> DataFrame:
    missing = orphan_keys(source, target, ref).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("violations"))
    return _as_results(missing, REFERENCE, ref.source, ref.target, str(ref))


def orphan_rows(source: DataFrame, target: DataFrame, ref: Reference) -> DataFrame:
    """The source rows themselves whose key is missing in the target."""
    if ref.allow_null:
        source = source.where(F.col(ref.column).isNotNull())
    known = target.select(F.col(ref.target_column).alias("_known"))
    return source.join(known, F.col(ref.column) == F.col("_known"), "left_anti")


def key_checks(layer: Layer, tables: dict[str, DataFrame]) -> DataFrame:
    """Referred keys and broken references of a whole layer in one aggregation; other keys by themselves, as they are.

    Keys that nothing refers to meet no other table.  They are mostly unique, so among the others they would crowd out
    of memory the few that combine before the shuffle.  Of the rest each row gives one entry per key it has or refers to; entries of one key meet, counted by what they are: rows
    of the keyed table, or of a reference to it.  Both sides of a reference and the duplicates of its target
    are then plain conditions on the counts.  Combined before the shuffle: a hot key is one row per task.
    """
    roles: dict[tuple[str, tuple[str, ...]], int] = {}
    entries: dict[str, list] = {}

    def role(of: tuple[str, tuple[str, ...]], table: str, columns: tuple[str, ...], key_of: int | None) -> int:
        number = len(roles)
        roles[of] = number
        key = F.array(*[F.col(c).cast("string") for c in columns])
        place = F.lit(number if key_of is None else key_of)
        entries.setdefault(table, []).append(F.struct(place.alias("key_of"), key.alias("key"), F.lit(number).alias("role")))
        return number

    keyed = list(dict.fromkeys([(r.target, (r.target_column,)) for r in layer.references]))
    alone = [duplicate_key_check(tables[t], t, keys) for t, keys in layer.keys.items() if (t, keys) not in keyed]
    if not keyed:
        return reduce(DataFrame.unionAll, alone)
    owners = {of: role(of, of[0], of[1], None) for of in keyed}
    users = {
        ref: role((str(ref), ()), ref.source, (ref.column,), owners[ref.target, (ref.target_column,)]) for ref in layer.references
    }
    cells = [tables[table].select(F.inline(F.array(*own))) for table, own in entries.items()]
    count = lambda n: F.count_if(F.col("role") == n).alias(f"_{n}")
    met = reduce(DataFrame.unionAll, cells).groupBy("key_of", "key").agg(*[count(n) for n in roles.values()])

    results = []
    for table, keys in layer.keys.items():
        if (table, keys) not in owners:
            continue
        doubled = F.count_if(F.col(f"_{owners[table, keys]}") > 1)
        results.append((DUPLICATE_KEY, table, None, ",".join(keys), doubled))
    for ref, user in users.items():
        missing = F.col("key")[0].isNull() if not ref.allow_null else F.lit(False)
        missing |= F.col("key")[0].isNotNull() & (F.col(f"_{owners[ref.target, (ref.target_column,)]}") == 0)
        orphans = F.coalesce(F.sum(F.when(missing, F.col(f"_{user}"))), F.lit(0))
        results.append((REFERENCE, ref.source, ref.target, str(ref), orphans))
    totals = met.agg(*[violations.alias(f"v{i}") for i, (*_, violations) in enumerate(results)])
    rows = [
        F.struct(
            F.lit(check).alias("check"), F.lit(table).alias("table"), F.lit(other).cast("string").alias("other_table"),
            F.lit(columns).alias("columns"), F.col(f"v{i}").cast("bigint").alias("violations"),
        )
        for i, (check, table, other, columns, _) in enumerate(results)
    ]
    return reduce(DataFrame.unionAll, [totals.select(F.inline(F.array(*rows))), *alone])


def constraint_report(layer: Layer, tables: dict[str, DataFrame]) -> DataFrame:
    """All checks the contract declares for a layer: a scan a table for its rows, one for its references, one per key nothing refers to."""
    results = [
        row_checks(tables[name], name, layer.keys.get(name, ()), declared_widths(schema))
        for name, schema in layer.tables.items()
    ]
    if layer.keys or layer.references:
        results.append(key_checks(layer, tables))
    return reduce(DataFrame.unionAll, results)


def _verdict(failed, good: str, bad: str):
    return F.when(F.coalesce(failed, F.lit(False)), F.lit(bad)).otherwise(F.lit(good))


def status_per_table(report: DataFrame) -> DataFrame:
    """PASS/FAIL per check and SUCCESS/FAILED per table; a broken reference marks both its tables."""
    marked = report.select(
        F.explode(F.array_compact(F.array("table", "other_table"))).alias("table"),
        "check",
        (F.col("violations") > 0).alias("failed"),
    )

    def any_failed(check: str):
        return F.bool_or(F.when(F.col("check") == check, F.col("failed")))

    return marked.groupBy("table").agg(
        _verdict(any_failed(REFERENCE), "PASS", "FAIL").alias("referential_integrity"),
        _verdict(any_failed(NULL_KEY), "PASS", "FAIL").alias("null_key_check"),
        _verdict(any_failed(DUPLICATE_KEY), "PASS", "FAIL").alias("duplicate_key_check"),
        _verdict(F.bool_or("failed"), "SUCCESS", "FAILED").alias("validation_status"),
    )


def status_for_layer(report: DataFrame) -> DataFrame:
    """One status for every table of the layer: FAILED as soon as any check failed."""
    worst = report.agg(F.max("violations").alias("worst")).scalar()
    return report.select("table").distinct().withColumn(
        "validation_status", _verdict(worst > 0, "SUCCESS", "FAILED")
    )


def flag_rates(df: DataFrame, flags: list[str]) -> DataFrame:
    """Share of 'Y' per flag column, in one row."""
    return df.agg(*[flag_rate(F.col(f)).alias(f) for f in flags])


def gate(layer: str, report: DataFrame) -> None:
    """Raise with the failed checks.  The report has one row per declared check, so it is small."""
    failed = [r.asDict() for r in report.where(F.col("violations") > 0).collect()]
    if failed:
        raise ValidationFailed(layer, failed)
