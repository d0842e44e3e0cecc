import pytest

from oreflow.operators import checks, reconcile
from oreflow.schemas import INT, Layer, Reference, table, text

SMALL = Layer(
    "small",
    {"child": table(cid=INT, pid=INT, name=text(3)), "parent": table(pid=INT), "other": table(oid=INT)},
    keys={"child": ("cid",), "parent": ("pid",), "other": ("oid",)},
    references=(Reference("child", "pid", "parent", "pid"),),
)


def tables(spark, child, parent=((1,), (2,)), other=((1,),)):
    data = {"child": child, "parent": parent, "other": other}
    return {name: spark.createDataFrame(list(data[name]), schema) for name, schema in SMALL.tables.items()}


def broken(report):
    return {(r["check"], r["table"], r["columns"]): r["violations"] for r in report.collect() if r["violations"]}


@pytest.mark.parametrize(
    "child, expected",
    [
        ([(1, 1, "abc"), (2, 2, None)], {}),
        ([(None, 1, "a"), (2, 2, "b")], {("null_key", "child", "cid"): 1}),
        ([(None, 1, "a"), (None, 2, "b")], {("null_key", "child", "cid"): 2, ("duplicate_key", "child", "cid"): 1}),
        ([(1, 1, "abcd"), (1, 1, "b")], {("duplicate_key", "child", "cid"): 1, ("width", "child", "name"): 1}),
        ([(1, 9, "a"), (2, 9, "a"), (3, None, "a")], {("reference", "child", "child.pid->parent.pid"): 3}),
    ],
)
def test_report(spark, child, expected):
    assert broken(checks.constraint_report(SMALL, tables(spark, child))) == expected


def test_optional_reference_ignores_null(spark):
    t = tables(spark, [(1, None, "a"), (2, 9, "a")])
    ref = Reference("child", "pid", "parent", "pid", allow_null=True)
    assert [tuple(r) for r in checks.orphan_keys(t["child"], t["parent"], ref).collect()] == [(9, 1)]
    assert [r["cid"] for r in checks.orphan_rows(t["child"], t["parent"], ref).collect()] == [2]
    strict = Reference("child", "pid", "parent", "pid")
    assert {r["cid"] for r in checks.orphan_rows(t["child"], t["parent"], strict).collect()} == {1, 2}


def test_composite_keys_group_nulls(rows):
    df = rows([(1, None), (1, None), (1, 2), (2, 2)], "a int, b int")
    assert [tuple(r) for r in checks.duplicate_keys(df, ["a", "b"]).collect()] == [(1, None, 2)]


def test_a_broken_reference_marks_both_tables(spark):
    report = checks.constraint_report(SMALL, tables(spark, [(1, 9, "a"), (None, 1, "b")]))
    got = {r["table"]: r.asDict() for r in checks.status_per_table(report).collect()}
    assert got["child"]["referential_integrity"] == got["parent"]["referential_integrity"] == "FAIL"
    assert (got["child"]["null_key_check"], got["parent"]["null_key_check"]) == ("FAIL", "PASS")
    assert [got[t]["validation_status"] for t in ("child", "parent", "other")] == ["FAILED", "FAILED", "SUCCESS"]
    assert {r["validation_status"] for r in checks.status_for_layer(report).collect()} == {"FAILED"}


def test_gate(spark):
    checks.gate("small", checks.constraint_report(SMALL, tables(spark, [(1, 1, "a")])))
    bad = checks.constraint_report(SMALL, tables(spark, [(1, 9, "a")]))
    with pytest.raises(checks.ValidationFailed, match="reference child") as caught:
        checks.gate("small", bad)
    assert caught.value.failed[0]["violations"] == 1


def test_an_empty_table_passes(spark):
    report = checks.constraint_report(SMALL, tables(spark, [], parent=[], other=[]))
    assert broken(report) == {} and report.count() == 8
    assert {r["validation_status"] for r in checks.status_for_layer(report).collect()} == {"SUCCESS"}


def test_reconcile_and_key_difference(rows):
    a = rows([("x",), ("x",), ("y",), (None,)], "k string")
    b = rows([("x",), ("z",), (None,)], "k string")
    got = {r["k"]: (r["left_rows"], r["right_rows"], r["outcome"]) for r in reconcile.reconcile(a, b, ["k"]).collect()}
    assert got == {"x": (2, 1, "COUNT_MISMATCH"), "y": (1, None, "ONLY_LEFT"), "z": (None, 1, "ONLY_RIGHT"), None: (1, 1, "MATCH")}
    diff = {(r["k"], r["outcome"]) for r in reconcile.key_set_difference(a, b, ["k"]).collect()}
    assert diff == {("y", "ONLY_LEFT"), ("z", "ONLY_RIGHT")}
    assert reconcile.key_set_difference(a, a, ["k"]).isEmpty()


def test_a_key_nothing_refers_to_is_counted_as_it_is(rows):
    layer = Layer(
        "l", {"a": table(k=INT, p=text(3)), "b": table(p=text(3))}, {"a": ("k", "p"), "b": ("p",)}, (Reference("a", "p", "b", "p"),)
    )
    tables = {"a": rows([(1, "x"), (1, "x"), (None, "y"), (None, "y"), (2, None), (1, "xx")], "k int, p string"),
              "b": rows([("x",), ("x",), (None,), (None,)], "p string")}
    report = checks.key_checks(layer, tables)
    found = {(r["check"], r["table"], r["columns"]): r["violations"] for r in report.collect()}
    assert found == {
        ("duplicate_key", "a", "k,p"): 2, ("duplicate_key", "b", "p"): 2, ("reference", "a", "a.p->b.p"): 4,
    }
    assert "Aggregate [k#" in report._jdf.queryExecution().optimizedPlan().toString()
    alone = Layer("l", {"b": table(p=text(3))}, {"b": ("p",)})
    assert [tuple(r) for r in checks.key_checks(alone, tables).collect()] == [("duplicate_key", "b", None, "p", 2)]
