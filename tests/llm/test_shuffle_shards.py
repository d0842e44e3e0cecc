import math
from collections import Counter

from pyspark.sql import functions as F

from oreflow.llm.shuffle_shards import communication_matrix, hypergeometric, hypergeometric_shuffle, uniform


def test_draws_follow_the_distribution(spark):
    good, bad, draws, n = 6, 9, 5, 20_000
    df = spark.range(n).select(
        hypergeometric(F.lit(good), F.lit(bad), F.lit(draws), uniform(F.lit(3), F.col("id"))).alias("k")
    )
    seen = Counter(r.k for r in df.collect())
    for k in range(draws + 1):
        p = math.comb(good, k) * math.comb(bad, draws - k) / math.comb(good + bad, draws)
        assert abs(seen[k] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-9


def test_extreme_draws(spark):
    row = spark.range(1).select(
        hypergeometric(F.lit(0), F.lit(9), F.lit(5), F.lit(0.999)).alias("none"),
        hypergeometric(F.lit(9), F.lit(0), F.lit(5), F.lit(0.0)).alias("all"),
        hypergeometric(F.lit(4), F.lit(4), F.lit(8), F.lit(0.5)).alias("every"),
        hypergeometric(F.lit(4), F.lit(4), F.lit(0), F.lit(0.5)).alias("no"),
    ).first()
    assert tuple(row) == (0, 5, 4, 0)


def test_matrix_sums(spark):
    parts = spark.createDataFrame([(i, 1 + 37 * i % 101) for i in range(13)], "part int, rows long")
    total = sum(r.rows for r in parts.collect())
    rows = communication_matrix(parts, total, 7, seed=5).collect()
    columns = [0] * 7
    for r in rows:
        counts = [b - a for a, b in zip([0, *r.until], r.until)]
        assert min(counts) >= 0 and r.until[-1] == r.rows
        columns = [a + b for a, b in zip(columns, counts)]
    assert len(rows) == 13 and sum(columns) == total and max(columns) - min(columns) <= 1


def test_all_rows_once(odd_docs, spark):
    docs = odd_docs.repartition(5).unionByName(odd_docs)
    out = hypergeometric_shuffle(docs, shards=3, cell_rows=2)
    assert out.columns == [*docs.columns, "shard", "slot"]
    got = out.collect()
    key = lambda r: str(tuple(r)[:5])
    assert sorted(map(key, got)) == sorted(map(key, docs.collect()))
    sizes = Counter(r.shard for r in got)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    for shard, size in sizes.items():
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(size))


def test_fewer_rows_than_shards_and_none(odd_docs, no_docs):
    got = hypergeometric_shuffle(odd_docs.limit(3), shards=40).collect()
    assert len(got) == 3 and len({r.shard for r in got}) == 3 and {r.slot for r in got} == {0}
    assert hypergeometric_shuffle(no_docs).count() == 0


def test_places_are_even(spark):
    """Over many seeds, each of four rows lands in each of two shards about equally often."""
    docs = spark.range(4).repartition(2)
    seen = Counter()
    for seed in range(40):
        seen.update((r.id, r.shard) for r in hypergeometric_shuffle(docs, shards=2, seed=seed).collect())
    assert all(8 <= seen[i, s] <= 32 for i in range(4) for s in range(2))


def test_rows_survive_another_cut_of_the_files(spark, tmp_path):
    """The copy may be cut into other tasks when the result is computed than when it was planned."""
    path = str(tmp_path / "docs")
    spark.range(1000).withColumn("text", F.col("id").cast("string")).repartition(6).write.parquet(path)
    names = ["spark.sql.leafNodeDefaultParallelism", "spark.sql.files.openCostInBytes"]
    before = {n: spark.conf.get(n, None) for n in names}

    def shuffled(planned, run):
        spark.conf.set(names[1], "1")
        spark.conf.set(names[0], planned)
        out = hypergeometric_shuffle(spark.read.parquet(path), shards=40)
        spark.conf.set(names[0], run)
        return sorted(map(tuple, out.collect()))

    try:
        for planned, run in [("4", "4"), ("4", "16"), ("16", "4")]:
            got = shuffled(planned, run)
            assert [r[0] for r in got] == list(range(1000))
            assert set(Counter(r[2] for r in got).values()) == {25}
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
