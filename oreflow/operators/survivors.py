"""Record survivorship: which of several records of one key to keep."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.functions.values import null_count
from oreflow.operators.groups import with_group_stats


def survivors(
    df: DataFrame,
    key: str,
    record_id: str,
    date: str,
    described_by: list[str],
) -> DataFrame:
    """Keep the fullest, then latest records of each key.

    * A key with one row keeps it if ``record_id`` is known.
    * A key with several rows (NULL is one key) looks at the rows with the fewest NULLs among
      ``described_by``; of these, the ones with an id and a date that have the latest date stay.
      Ties all stay, and a key whose fullest rows lack an id or date keeps nothing.

    The latest date is needed among the fullest rows only, which a second window would have to
    look up after the first.  One latest date per possible NULL count gives it in the same pass,
    and each is a plain aggregate, so map-side combine and hash aggregation apply.
    """
    nulls = F.col("_nulls")
    usable = F.col(record_id).isNotNull() & F.col(date).isNotNull()
    levels = range(len(described_by) + 1)
    counted = df.withColumn("_nulls", null_count(*[F.col(c) for c in described_by]))
    judged = with_group_stats(
        counted,
        [key],
        {
            "_copies": F.count(F.lit(1)),
            "_least": F.min(nulls),
            **{f"_latest_{n}": F.max(F.when((nulls == n) & usable, F.col(date))) for n in levels},
        },
    )
    # Only rows with _nulls = _least are compared, so the row's own level is the right one.
    latest = F.coalesce(*[F.when(nulls == n, F.col(f"_latest_{n}")) for n in levels])
    single = (F.col("_copies") == 1) & F.col(record_id).isNotNull()
    best = (F.col("_copies") > 1) & usable & (nulls == F.col("_least")) & (F.col(date) == latest)
    return judged.where(single | best).select(*df.columns)
