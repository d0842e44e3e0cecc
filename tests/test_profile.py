import threading
from collections import Counter

from pyspark.sql import DataFrameWriter

from oreflow.operators import profile
from oreflow.schemas import BRONZE
from oreflow.sources import delimited
from oreflow.workload import queries


def by_column(df):
    return {r["column"]: r for r in df.collect()}


def test_profile(rows):
    data = [("1", "x", None, "True", "5", "2024-01-01", "é")] * 10 + [
        ("2.5", "yy", "", "false", "n/k", "soon", "ab"), (None, "yy", "NA", "True", "6", "2024-01-02", "ab")
    ]
    df = rows(data, "num string, txt string, nothing string, bool string, mixed string, day string, uni string")
    got = by_column(profile.profile(df, "t"))
    kinds = {c: r["data_type"] for c, r in got.items()}
    # ``num`` has a NULL, but every value it has is a number.
    assert kinds == {
        "num": "Numeric", "txt": "String", "nothing": "Empty", "bool": "Boolean", "mixed": "Numeric as String",
        "day": "Date as String", "uni": "String",
    }
    num = got["num"]
    assert (num["numeric_min"], num["numeric_max"], num["min_length"], num["max_length"]) == (1.0, 2.5, 1, 3)
    assert (num["null_count"], num["row_count"], num["cardinality"]) == (1, 12, 2)
    assert abs(num["null_pct"] - 1 / 12) < 1e-12
    assert got["txt"]["top_values"] == "High Cardinality" and got["txt"]["numeric_max"] is None
    assert got["nothing"]["top_values"] == "" and got["nothing"]["max_length"] is None
    assert got["uni"]["max_length"] == 2


def test_value_set_lists_three_with_ties_by_value(rows):
    df = rows([(v,) for v in ["b"] * 20 + ["a"] * 20 + ["d"] * 5 + ["c"] * 5], "v string")
    assert by_column(profile.profile(df, "t"))["v"]["top_values"] == "a(20), b(20), c(5)"


def test_bits_are_boolean_and_empty_tables_profile(rows):
    assert by_column(profile.profile(rows([("1",), ("0",), (None,)], "v string"), "t"))["v"]["data_type"] == "Boolean"
    empty = by_column(profile.profile(rows([], "v string, w string"), "t"))
    assert {r["data_type"] for r in empty.values()} == {"Empty"} and empty["w"]["row_count"] == 0


def test_profile_of_files(spark, tmp_path):
    for folder, name, body in [
        ("src_crm", "Cust_Info.csv", b"id,name\r\n1,\"A, B\"\r\n2,\r\n"), ("src_erp", "loc.csv", b"k\nx\n")
    ]:
        (tmp_path / folder).mkdir()
        (tmp_path / folder / name).write_bytes(body)
    report = delimited.profile_files(spark, str(tmp_path))
    got = {(r["name"], r["column"]): r for r in report.collect()}
    assert set(got) == {("crm_cust_info", "id"), ("crm_cust_info", "name"), ("erp_loc", "k")}
    assert got["crm_cust_info", "name"]["null_count"] == 1 and got["crm_cust_info", "name"]["max_length"] == 4
    out = str(tmp_path / "report")
    delimited.write_report(profile.with_headings(report), out)
    back = spark.read.option("header", True).csv(out)
    assert back.columns == list(profile.HEADINGS.values()) and back.count() == 3


def test_cells_are_counted_under_a_number(rows):
    data = [("a", None, "NULL"), ("a", "a", ""), ("b", "a", " "), (None, "1", "a"), ("a", "a", "a")]
    df = rows(data, "v string, `column` string, n string")
    counts = profile.value_counts(df)
    want = Counter((c, None if r[i] in profile.NULL_TOKENS else r[i]) for r in data for i, c in enumerate(df.columns))
    got = Counter()
    for r in counts.collect():
        got[r["column"], r["value"]] += r["n"]
    assert +got == want and {c for c, _ in got} == set(df.columns)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_place#" in plan and "Expand" not in plan


def test_raw_files_are_written_together(spark, monkeypatch):
    texts = {t: queries.RAW[t] for t in ("erp_loc_a101", "erp_cust_az12", "crm_cust_info")}
    together = threading.Barrier(len(texts), timeout=60)
    write = DataFrameWriter.csv

    def csv(self, path, *args, **kwargs):
        together.wait()
        return write(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "csv", csv)
    root = queries.as_files(spark, "/root/testdata/sf0.001", texts)
    found = delimited.tables_found(spark, root)
    assert set(found) == set(texts)
    for table, paths in found.items():
        expected = queries.raw(spark, "/root/testdata/sf0.001", table).count()
        assert delimited.read_delimited(spark, paths, BRONZE.tables[table]).count() == expected
