"""Which date formats a text column can have, by the evidence of all its values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.operators.frequent import cells_of

_MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
_NAME = "(" + "|".join(_MONTHS) + ")"

# Shapes, with the places of year, month and day among their groups.
FORMATS = {
    "yyyy-MM-dd": (r"^(\d{4})-(\d{1,2})-(\d{1,2})$", (1, 2, 3)),
    "yyyy-MM-dd HH:mm:ss": (r"^(\d{4})-(\d{1,2})-(\d{1,2}) ([01]\d|2[0-3]):[0-5]\d:[0-5]\d$", (1, 2, 3)),
    "yyyyMMdd": (r"^(\d{4})(\d{2})(\d{2})$", (1, 2, 3)),
    "M/d/yyyy": (r"^(\d{1,2})/(\d{1,2})/(\d{4})$", (3, 1, 2)),
    "d/M/yyyy": (r"^(\d{1,2})/(\d{1,2})/(\d{4})$", (3, 2, 1)),
    "d.M.yyyy": (r"^(\d{1,2})\.(\d{1,2})\.(\d{4})$", (3, 2, 1)),
    "d MMM yyyy": (rf"^(\d{{1,2}}) {_NAME} (\d{{4}})$", (3, 2, 1)),
    "MMM d, yyyy": (rf"^{_NAME} (\d{{1,2}}), (\d{{4}})$", (3, 1, 2)),
}
SEVERAL = " or "


def date_by(value: Column, name: str) -> Column:
    """The date a text is in one format; NULL if it does not have its shape or names no day of the calendar."""
    shape, (year, month, day) = FORMATS[name]
    part = lambda group: F.regexp_extract(value, shape, group)
    if "MMM" in name:
        months = F.array(*[F.lit(m) for m in _MONTHS])
        month_ = F.array_position(months, part(month)).cast("int")
    else:
        month_ = part(month).try_cast("int")
    year_, day_ = part(year).try_cast("int"), part(day).try_cast("int")
    first = F.when((year_ >= 1) & month_.between(1, 12), F.make_date(year_, month_, F.lit(1)))
    return F.when(day_.between(1, F.day(F.last_day(first))), F.date_add(first, day_ - 1))


# Shapes exclude each other, so a text has one at most; formats that share a shape differ in the order of its groups.
SHAPES = tuple(dict.fromkeys(shape for shape, _ in FORMATS.values()))
# Every order of year, month and day in which some format reads the groups of its shape.
ORDERS = tuple(dict.fromkeys(places for _, places in FORMATS.values()))


def _day_of(year: Column, month: Column, day: Column) -> Column:
    """The date of three numbers; NULL if they name no day of the calendar."""
    leap = (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))
    days = F.when(month.isin(4, 6, 9, 11), 30).when(month != 2, 31).when(leap, 29).otherwise(28)
    known = (year >= 1) & month.between(1, 12) & (day >= 1) & (day <= days)
    return F.when(known, F.make_date(year, month, day))


def read_dates(cells: DataFrame) -> DataFrame:
    """(column, _shape, _date_0, ..): the shape of each value, NULL if it has none, and the date it gives in each order
    of its groups, NULL if none: what ``date_by`` gives, whatever the format.

    Step by step, each on columns of the one before, so that a value is matched and cut up once.  The groups of a text
    with a shape are its first runs of digits or letters, which keeps the code of the scan small enough to be compiled.
    """
    value = F.col("value")
    shape = F.lit(None).cast("int")
    for i in reversed(range(len(SHAPES))):
        shape = F.when(value.rlike(SHAPES[i]), i).otherwise(shape)
    compact = F.concat_ws("-", F.left(value, F.lit(4)), F.substring(value, 5, 2), F.substring(value, 7, 2))
    text = F.when(F.col("_shape") == SHAPES.index(FORMATS["yyyyMMdd"][0]), compact).otherwise(value)
    runs = F.when(F.col("_shape").isNotNull(), F.split(text, "[^0-9A-Za-z]+"))
    # A run is a number or, in a text that has a shape, a month's name.
    number = lambda c: F.coalesce(c.try_cast("int"), F.floor((F.instr(F.lit("".join(_MONTHS)), c) + 2) / 3).cast("int"))
    dates = [_day_of(*[F.col(f"_n{g}") for g in places]).alias(f"_date_{i}") for i, places in enumerate(ORDERS)]
    return (
        cells.select("column", "value", shape.alias("_shape"))
        .select("column", "_shape", runs.alias("_runs"))
        .select("column", "_shape", *[F.get("_runs", F.lit(g)).alias(f"_g{g + 1}") for g in range(3)])
        .select("column", "_shape", *[number(F.col(f"_g{g}")).alias(f"_n{g}") for g in (1, 2, 3)])
        .select("column", "_shape", *dates)
    )


def date_formats(df: DataFrame, null_tokens: tuple[str, ...] = ()) -> DataFrame:
    """One row per column that has a value: what its values can be as dates.

    ``formats`` lists the formats that read the most values (none: NULL), several where the values do not tell them
    apart, as day and month up to 12 do; one value above 12 settles it.  ``dates`` is how many values they read,
    ``ambiguous`` whether several are left, ``first`` and ``last`` the range of days where one is.  ``mostly`` is
    the rule of the profile: more than half of the values.

    One scan for all columns and formats; the state per column and shape is a few numbers.
    """
    names = list(FORMATS)
    read = read_dates(cells_of(df, null_tokens))
    # A row per column and shape; from here on there are few.
    counted = read.groupBy("column", "_shape").agg(
        F.count(F.lit(1)).alias("values"),
        *[F.count(f"_date_{i}").alias(f"_n_{i}") for i in range(len(ORDERS))],
        *[f(f"_date_{i}").alias(f"_{end}_{i}") for i in range(len(ORDERS)) for f, end in ((F.min, "first"), (F.max, "last"))],
    )
    own = {i: (F.col("_shape") == SHAPES.index(shape), ORDERS.index(places)) for i, (shape, places) in enumerate(FORMATS.values())}
    totals = counted.groupBy("column").agg(
        F.sum("values").alias("values"),
        *[F.coalesce(F.sum(F.when(here, F.col(f"_n_{o}"))), F.lit(0)).alias(f"_{i}_n") for i, (here, o) in own.items()],
        *[
            f(F.when(here, F.col(f"_{end}_{o}"))).alias(f"_{i}_{end}")
            for i, (here, o) in own.items() for f, end in ((F.min, "first"), (F.max, "last"))
        ],
    )
    each = F.array(
        *[
            F.struct(F.lit(name).alias("name"), F.col(f"_{i}_n").alias("n"), F.col(f"_{i}_first").alias("first"), F.col(f"_{i}_last").alias("last"))
            for i, name in enumerate(names)
        ]
    )
    most = F.greatest(*[F.col(f"_{i}_n") for i in range(len(names))])
    best = totals.select("column", "values", most.alias("dates"), F.filter(each, lambda f: f["n"] == most).alias("best"))
    found = F.col("dates") > 0
    alone = found & (F.size("best") == 1)
    return best.select(
        "column",
        "values",
        "dates",
        F.when(found, F.array_join(F.transform("best", lambda f: f["name"]), SEVERAL)).alias("formats"),
        (found & (F.size("best") > 1)).alias("ambiguous"),
        (F.col("dates") * 2 > F.col("values")).alias("mostly"),
        F.when(alone, F.col("best")[0]["first"]).alias("first"),
        F.when(alone, F.col("best")[0]["last"]).alias("last"),
    )
