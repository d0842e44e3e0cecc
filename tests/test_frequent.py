"""Frequent values, distinct sketches and date formats."""

import datetime
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from oreflow.operators import dates, frequent, sketches


def top(counts, k=3):
    return sorted(counts.items(), key=lambda c: (-c[1], c[0]))[:k]


# Few candidates and counters make the sketch miss and its bound fail; flat columns do in any case.
@pytest.mark.parametrize("settings", [{}, {"candidates": 3, "tracked": 8, "counters": 4}])
def test_top_values_are_exact(rows, settings):
    rng = random.Random(4)
    data = [
        (str(rng.paretovariate(0.6))[:4], f"u{i}", "same", None if i % 3 else "x", str(rng.randrange(5)))
        for i in range(3000)
    ]
    df = rows(data, "skewed string, flat string, one string, few string, five string").repartition(5)
    found = {}
    for r in frequent.frequent_values(df, null_tokens=("same",), **settings).collect():
        assert (r.column, r.value) not in found
        found[r.column, r.value] = r.n
    for i, column in enumerate(df.columns):
        counts = Counter(r[i] for r in data if r[i] not in (None, "same"))
        assert top({v: n for (c, v), n in found.items() if c == column}) == top(counts)


def test_a_skewed_column_is_proved_without_a_third_pass(rows):
    df = rows([("hot" if i % 2 else "warm" if i % 3 else "cool" if i % 5 else f"v{i}",) for i in range(6000)], "a string")
    assert frequent.frequent_values(df).count() <= frequent.CANDIDATES


def test_no_rows(rows):
    empty = rows([], "a string, b int")
    assert frequent.frequent_values(empty).count() == 0
    assert sketches.distinct_sketches(empty).count() == 0
    assert dates.date_formats(empty).count() == 0


def test_sketches_of_runs_merge(spark, tmp_path):
    path = str(tmp_path / "sketches")
    for run, (first, last) in enumerate([(0, 30_000), (20_000, 50_000), (0, 10)]):
        df = spark.range(first, last).selectExpr("id", "id % 7 AS seven", "cast(NULL AS string) AS none")
        sketches.keep(df, path, f"run-{run}")
        sketches.keep(df, path, f"run-{run}")
    got = {r.column: r.cardinality for r in sketches.merged(sketches.kept(spark, path)).collect()}
    assert got.keys() == {"id", "seven"} and got["seven"] == 7
    assert abs(got["id"] - 50_000) <= 0.02 * 50_000


@pytest.mark.parametrize(
    "value,name,want",
    [
        ("2024-02-29", "yyyy-MM-dd", (2024, 2, 29)), ("2023-02-29", "yyyy-MM-dd", None), ("20241340", "yyyyMMdd", None),
        ("20241231", "yyyyMMdd", (2024, 12, 31)), ("1/31/2024", "M/d/yyyy", (2024, 1, 31)), ("1/31/2024", "d/M/yyyy", None),
        ("31.1.2024", "d.M.yyyy", (2024, 1, 31)), ("5 Mar 2024", "d MMM yyyy", (2024, 3, 5)), ("5 Mai 2024", "d MMM yyyy", None),
        ("Mar 5, 2024", "MMM d, yyyy", (2024, 3, 5)), ("0000-01-01", "yyyy-MM-dd", None), (None, "yyyy-MM-dd", None),
        ("2024-01-01 24:00:00", "yyyy-MM-dd HH:mm:ss", None), ("2024-01-01 23:00:00", "yyyy-MM-dd HH:mm:ss", (2024, 1, 1)),
        ("", "yyyyMMdd", None),
    ],
)
def test_dates_of_a_format(rows, value, name, want):
    df = rows([(value,)], "v string")
    assert df.select(dates.date_by(df.v, name)).first()[0] == (datetime.date(*want) if want else None)


def test_one_value_settles_day_and_month(rows):
    open_ = [("03/04/2024",), ("05/06/2024",), (None,)]
    both = dates.date_formats(rows(open_, "v string")).first()
    assert both.formats == "M/d/yyyy or d/M/yyyy" and both.ambiguous and both.first is None and both.dates == 2
    settled = dates.date_formats(rows([*open_, ("25/12/2024",), ("soon",)], "v string")).first()
    assert settled.formats == "d/M/yyyy" and not settled.ambiguous and settled.mostly and (settled.dates, settled["values"]) == (3, 4)
    assert (settled.first, settled.last) == (datetime.date(2024, 4, 3), datetime.date(2024, 12, 25))


def test_a_value_is_matched_once_per_shape_and_read_as_by_its_format(rows):
    texts = [
        "2024-02-29", "2023-02-29", "2024-2-9", "2024-02-29 23:59:59", "2024-02-29 24:00:00", "20240229", "20241301", "0000-01-01",
        "12/31/2024", "31/12/2024", "13/13/2024", "1.2.2024", "31.02.2024", "3 Mar 2024", "Mar 3, 2024", "Mai 3, 2024", "30 Feb 2024",
        "2024-02-29\n", "1.2.2024\n", "2024-02-29 ", "20240229\n", " 2024-02-29", "soon", "", "99999999", "1900-02-29",
    ]
    for text in texts:
        want = rows([(text,)], "v string").select(*[dates.date_by(F.col("v"), n).alias(n) for n in dates.FORMATS]).first().asDict()
        got = dates.date_formats(rows([(text,)], "v string")).first()
        read = [n for n, day in want.items() if day is not None]
        assert got.formats == (dates.SEVERAL.join(read) or None), text
        assert got.first == (want[read[0]] if len(read) == 1 else None), text
    plan = dates.date_formats(rows([("a", "b")], "v string, w string"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("RLIKE") <= 2 * len(dates.SHAPES) and "regexp_extract" not in plan
