"""Fingerprints, the hash tree and the refresh of changed keys."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

from oreflow.operators import changes
from oreflow.plans.incremental import Incremental
from oreflow.schemas import table
from oreflow.session import written
from oreflow.sources.buckets import BucketTable
from oreflow.workload.raw_sources import CHANGES, NEXT, SOUND, changed as by_changes, derive

SF = "/root/testdata/sf0.001"


def prints(df):
    return changes.fingerprints(df, F.col("k"))


def changed(before, after):
    return {(r.key, r.change) for r in changes.key_changes(prints(before), prints(after)).collect()}


def test_fingerprints_see_multisets_not_order(rows):
    ddl = "k string, a string, b string"
    first = rows([("x", "1", None), ("x", "2", "3"), ("y", "1", "1"), (None, "n", None), ("z", "d", "d")], ddl)
    same = rows([("y", "1", "1"), ("z", "d", "d"), (None, "n", None), ("x", "2", "3"), ("x", "1", None)], ddl)
    other = rows([("x", None, "1"), ("x", "2", "3"), ("z", "d", "d"), ("z", "d", "d"), ("w", "1", "1"), (None, None, "n")], ddl)
    assert changed(first, same) == set()
    assert changed(first, other) == {
        ("x", "CHANGED"), ("y", "REMOVED"), ("w", "ADDED"), ("z", "CHANGED"), (None, "CHANGED")
    }
    assert changed(first.limit(0), first.limit(0)) == set()


@pytest.mark.parametrize("leaf_rows", [1 << 14, 8])
def test_content_differences_are_those_of_whole_rows(rows, leaf_rows):
    left = [(i % 90, "v" if i % 5 else None) for i in range(300)]
    right = [*left[3:], (7, "v"), (7, "new"), (None, None)]
    ddl = "k long, v string"
    got = changes.content_differences(rows(left, ddl), rows(right, ddl), leaf_rows).collect()
    counts = Counter(left), Counter(right)
    want = {(*r, counts[0][r], counts[1][r]) for r in {*left, *right} if counts[0][r] != counts[1][r]}
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert changes.content_differences(rows(left, ddl), rows(left[::-1], ddl), leaf_rows).count() == 0
    assert changes.content_differences(rows(left, ddl).limit(0), rows(left, ddl).limit(0), leaf_rows).count() == 0


def test_only_differing_leaves_are_descended_to(rows):
    left = rows([(i,) for i in range(4096)], "k long")
    levels = changes.levels_for(4096, 1)
    sides = [changes.leaves(df, ["k"], levels) for df in (left, left.where("k <> 77"))]
    nodes = [r.node for r in changes.differing_leaves(*sides, levels).collect()]
    assert levels == 3 and nodes == [left.where("k = 77").select(changes.leaf_of(["k"], levels)).first()[0]]


def files(root):
    return {os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.startswith("part-")}


def test_refresh_of_changes_ends_like_a_full_one(spark, tmp_path):
    raw = [{t: derive(spark, SF, sql) for t, sql in texts.items()} for texts in (SOUND, NEXT)]
    whole, tables = (Incremental(spark, str(tmp_path / n), buckets=32) for n in ("whole", "changes"))
    whole.first(raw[1])
    tables.first(raw[0])
    before = files(tables.root)
    # A run that dies half way: its rows stay, its keys are noted.
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr("oreflow.plans.incremental.gold.dim_product", lambda cleaned: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            tables.refresh(raw[1])
    touched = tables.refresh(raw[1])
    for layer, names in (("silver", raw[0]), ("gold", ("dim_customer", "dim_product", "fact_sales"))):
        for table in names:
            got, want = (getattr(x, layer)(table).read() for x in (tables, whole))
            assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect())), table
            kept = files(f"{tables.root}/{layer}/{table}") & before
            old = {f for f in before if f.startswith(f"{tables.root}/{layer}/{table}/")}
            gone = {int(f.split("_bucket=")[1].split("/")[0]) for f in old - kept}
            assert gone <= set(touched.buckets[table])
            rewritten = files(f"{tables.root}/{layer}/{table}") - before
            assert {int(f.split("_bucket=")[1].split("/")[0]) for f in rewritten} <= set(touched.buckets[table])
    assert touched.keys["erp_cust_az12"] == 0 and touched.buckets["erp_cust_az12"] == []
    assert 0 < len(touched.buckets["dim_customer"]) < 32 and 0 < touched.keys["crm_cust_info"] < 20
    assert tables.refresh(raw[1]).buckets == {t: [] for t in touched.buckets}


def test_replacing_moves_new_rows_only_until_files_are_many(spark, rows, tmp_path, monkeypatch):
    """Kept rows are neither written twice nor shuffled; a bucket in many small files is put together."""
    ddl, schema = "k long, v string", table(k=LongType(), v=StringType())
    kept = BucketTable(spark, str(tmp_path / "t"), schema, lambda: F.col("k"), buckets=4)
    kept.create(rows([(i, "old") for i in range(400)] + [(None, "old"), (None, "old")], ddl))
    moved = []

    def noted(df):
        out = written(df)
        moved.append(out.count())
        return out

    monkeypatch.setattr("oreflow.sources.buckets.written", noted)
    want = {i: "old" for i in range(400)}
    for turn in range(3):
        keys = [turn, 100 + turn, None]
        fresh = [(turn, f"new{turn}"), (None, f"none{turn}")]
        moved.clear()
        kept.replace(rows([(k,) for k in keys], "key long"), rows(fresh, ddl))
        assert moved == [2]
        want[turn] = f"new{turn}"
        del want[100 + turn]
        assert Counter(map(tuple, kept.read().collect())) == Counter([*want.items(), (None, f"none{turn}")])
    many = len(files(kept.path))
    monkeypatch.setattr("oreflow.sources.buckets.MOST_FILES", 1)
    everywhere = rows([(k,) for k in range(3, 40)], "key long")
    kept.replace(everywhere, rows([(3, "last")], ddl))
    assert len(files(kept.path)) <= 5 < many
    assert Counter(r.k for r in kept.read().collect()) == Counter([k for k in want if not 3 < k < 40] + [None])
    # The last rows of a bucket leave.
    all_keys = kept.read().select(F.col("k").alias("key")).distinct().collect()
    kept.replace(rows([tuple(r) for r in all_keys], "key long"), rows([], ddl))
    assert kept.read().count() == 0


def test_the_next_extract_by_its_changes_is_the_one_by_its_text(spark):
    extract = {t: derive(spark, SF, sql, {"lineitem": "l_orderkey"}) for t, sql in SOUND.items()}
    for name, df in extract.items():
        following = by_changes(df, CHANGES[name]) if name in CHANGES else df
        for got, text in ((df, SOUND[name]), (following, NEXT[name])):
            assert Counter(map(tuple, got.collect())) == Counter(map(tuple, derive(spark, SF, text).collect())), name
