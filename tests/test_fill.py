import datetime

from oreflow.operators.fill import fill_from_siblings
from oreflow.operators.groups import with_group_stats
from pyspark.sql import functions as F

D = datetime.date


def test_fill(rows):
    data = [(1, 1, None), (2, 1, D(2021, 5, 1)), (3, 1, D(2021, 4, 1)), (4, 2, None), (5, None, None),
            (6, None, D(2020, 1, 1)), (7, 3, D(2019, 1, 1))]
    df = rows(data, "row int, grp int, day date").repartition(3)
    got = fill_from_siblings(df, "grp", "day", "filled").collect()
    assert {r["row"]: r["filled"] for r in got} == {
        1: D(2021, 5, 1), 2: D(2021, 5, 1), 3: D(2021, 4, 1), 4: None, 5: D(2020, 1, 1), 6: D(2020, 1, 1),
        7: D(2019, 1, 1),
    }
    assert {r["row"]: r["day"] for r in got} == {r[0]: r[2] for r in data}


def test_group_stats_of_several_keys(spark):
    df = spark.range(400, numPartitions=5).select(
        F.when(F.col("id") % 4 > 0, F.col("id") % 4).alias("k"), F.lit(None).cast("int").alias("none"), F.col("id").alias("v")
    )
    got = with_group_stats(df, ["k", "none"], {"n": F.count("v"), "top": F.max("v")})
    assert got.columns == ["k", "none", "v", "n", "top"]
    assert {(r["k"], r["n"], r["top"]) for r in got.collect()} == {(k or None, 100, 396 + k) for k in range(4)}
    assert got.count() == 400


def test_rows_with_a_value_are_not_shuffled(spark, tmp_path):
    ids = spark.range(2000)
    day = F.when(F.col("id") % 10 > 0, F.date_add(F.lit(D(2020, 1, 1)), F.col("id").cast("int")))
    ids.select("id", (F.col("id") % 500).alias("grp"), day.alias("day")).write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    filled = fill_from_siblings(df, "grp", "day", "filled")
    plan = filled._jdf.queryExecution().optimizedPlan()
    assert plan.nodeName() == "Union" and "Join" not in plan.children().apply(0).toString()
    got = {r["id"]: r for r in filled.collect()}
    assert len(got) == 2000 and filled.columns == [*df.columns, "filled"]
    assert all(r["filled"] == r["day"] for r in got.values() if r["day"])
    assert all(r["filled"] is None for r in got.values() if r["id"] % 10 == 0)
