"""Range-clustered loads."""

from collections import Counter

from oreflow.sources.tables import file_ranges, reload


def test_files_hold_ranges_that_do_not_overlap(spark, tmp_path):
    df = spark.range(5000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 700 ELSE (id * 7919) % 1009 END AS k", "nullif(id % 11, 0) AS n")
    path = str(tmp_path / "t")
    reload(df, df.schema, path, ["k"], files=6)
    table = spark.read.parquet(path)
    ranges = file_ranges(table, "k").orderBy("first", "last").collect()
    assert len(ranges) == 6 and sum(r.rows for r in ranges) == 5000
    assert all(r.before is None or r.first >= r.before for r in ranges)
    # The hot key, a third of all rows, is cut across files.
    assert sum(r.first <= 700 <= r.last for r in ranges) > 1 and max(r.rows for r in ranges) < 2000
    assert Counter(map(tuple, table.collect())) == Counter(map(tuple, df.collect()))


def test_unclustered_files_overlap(spark, tmp_path):
    df = spark.range(100).selectExpr("(id * 37) % 100 AS k").repartition(3)
    reload(df, df.schema, str(tmp_path / "t"))
    assert any(r.before is not None and r.first < r.before for r in file_ranges(spark.read.parquet(str(tmp_path / "t")), "k").collect())
