"""Group statistics that stay whole when one key holds a large share of the rows.

A plain window sends every row of a key to one task.  Here the statistics are a map-side combined aggregate,
and the rows meet them in a join, whose hot keys AQE splits.  There is no list of hot keys and no threshold.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_group_stats(df: DataFrame, keys: list[str], stats: dict[str, Column]) -> DataFrame:
    """Add ``agg OVER (PARTITION BY keys)`` columns; NULL keys form one group.

    ``df`` is evaluated twice, the first time with the columns that the statistics need only.
    """
    names = {k: f"_group_{k}" for k in keys}
    match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(name)) for k, name in names.items()])
    answers = df.groupBy(*keys).agg(*[c.alias(name) for name, c in stats.items()]).withColumnsRenamed(names)
    return df.join(answers, match).select(*[F.col(c) for c in df.columns], *stats)
