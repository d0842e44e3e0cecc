import pytest

from oreflow.schemas import BRONZE, text_table
from oreflow.sources import delimited

TWO = text_table(a=5, b=5)


def put(folder, name, body: bytes):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(body)
    return str(folder / name)


def test_scan_keeps_what_bulk_loading_keeps(spark, tmp_path):
    path = put(tmp_path, "x.csv", 'a,b\r\n1,"q"\r\n,  \r\n Andrés,back\\slash\r\n'.encode())
    got = {tuple(r) for r in delimited.read_delimited(spark, path, TWO).collect()}
    assert got == {("1", '"q"\r'), (None, "  \r"), (" Andrés", "back\\slash\r")}


def test_scan_is_by_position(spark, tmp_path):
    path = put(tmp_path, "x.csv", b"other,names\n1,2\n")
    assert delimited.read_delimited(spark, path, TWO).collect()[0].asDict() == {"a": "1", "b": "2"}


def test_line_count_sees_what_the_parser_skips(spark, tmp_path):
    path = put(tmp_path / "s_crm", "x.csv", b"a,b\n1,a\n\n2\n3,b,c")
    assert delimited.read_delimited(spark, path, TWO).count() == 3
    assert [(r["table"], r["rows"]) for r in delimited.source_line_counts(spark, str(tmp_path)).collect()] == [("crm_x", 4)]
    assert {r["_bad_line"] for r in delimited.bad_lines(spark, path, TWO).collect()} == {"2", "3,b,c"}


def test_discovery_names_tables_after_folder_and_file(spark, tmp_path):
    put(tmp_path / "source_crm" / "deep_erp", "LOC_A101.csv", b"a\n")
    put(tmp_path / "source_crm", "cust_info.csv", b"a\n1\n2\n")
    put(tmp_path / "plain", "x.y.csv", b"a\n")
    put(tmp_path / "plain", "note.txt", b"a\n")
    put(tmp_path / "a_b_c", "empty.csv", b"")
    counts = {r["table"]: r["rows"] for r in delimited.source_line_counts(spark, str(tmp_path)).collect()}
    assert counts == {"erp_loc_a101": 0, "crm_cust_info": 2, "plain_x.y": 0, "b_c_empty": 0}


def test_a_file_of_zero_bytes_is_an_empty_table(spark, tmp_path):
    put(tmp_path / "s_crm", "x y+1%.csv", b"")
    put(tmp_path / "s_crm", "y.csv", b"")
    put(tmp_path / "t_crm", "y.csv", b"a,b\n1,2\n")
    found = delimited.tables_found(spark, str(tmp_path))
    assert {t: len(paths) for t, paths in found.items()} == {"crm_x y+1%": 1, "crm_y": 2}
    assert delimited.read_delimited(spark, found["crm_x y+1%"], TWO).isEmpty()
    assert [tuple(r) for r in delimited.read_delimited(spark, found["crm_y"], TWO).collect()] == [("1", "2")]
    counts = delimited.source_line_counts(spark, str(tmp_path), fields={"crm_y": 2})
    got = sorted((r["table"], r["rows"], r["malformed"]) for r in counts.collect())
    assert got == [("crm_x y+1%", 0, None), ("crm_y", 0, 0), ("crm_y", 1, 0)]
    assert {r["table"] for r in delimited.discover(spark, str(tmp_path)).where("length = 0").collect()} == {"crm_x y+1%", "crm_y"}
    assert {r["name"] for r in delimited.profile_files(spark, str(tmp_path)).collect()} == {"crm_y"}


def test_a_folder_without_files_has_no_tables(spark, tmp_path):
    put(tmp_path / "s_crm", "note.txt", b"a\n")
    assert delimited.tables_found(spark, str(tmp_path)) == {}
    assert delimited.source_line_counts(spark, str(tmp_path)).isEmpty()


def test_bronze_schemas_are_all_text():
    assert all(f.dataType.simpleString() == "string" and f.metadata["width"] for s in BRONZE.tables.values() for f in s)


@pytest.mark.parametrize("end", [b"\n", b"\r\n"])
def test_a_final_line_without_row_end_counts(spark, tmp_path, end):
    put(tmp_path / "s_t", "x.csv", end.join([b"a", b"1", b"2"]))
    assert delimited.source_line_counts(spark, str(tmp_path)).first()["rows"] == 2


def test_tables_found_reads_every_folder_and_case(spark, tmp_path):
    put(tmp_path / "p_crm", "X.csv", b"a,b\n1,1\n")
    put(tmp_path / "q r_crm", "x.csv", b"a,b\n2,2\n")
    put(tmp_path / "p_crm", "xy.csv", b"a,b\n3,3\n")
    found = delimited.tables_found(spark, str(tmp_path))
    assert set(found) == {"crm_x", "crm_xy"} and len(found["crm_x"]) == 2
    assert {r["a"] for r in delimited.read_delimited(spark, found["crm_x"], TWO).collect()} == {"1", "2"}


@pytest.mark.parametrize("name", ["y[1].csv", "a b.csv", "50%.csv", "p+q.csv", "x{1,2}.csv", "straße.csv", "dash-[a-z].csv"])
def test_odd_file_names(spark, tmp_path, name):
    put(tmp_path / "s[0]_crm", name, b"a,b\n1,2\n")
    put(tmp_path / "s[0]_crm", "y1.csv", b"a,b\n3,4\n")
    found = delimited.tables_found(spark, str(tmp_path))
    table = "crm_" + name.removesuffix(".csv")
    assert set(found) == {table, "crm_y1"}
    assert [r["a"] for r in delimited.read_delimited(spark, found[table], TWO).collect()] == ["1"]
    assert {r["table"] for r in delimited.source_line_counts(spark, str(tmp_path)).collect()} == set(found)


def test_part_files_are_one_table(spark, tmp_path):
    for n in range(3):
        put(tmp_path / "source_crm" / "Big.csv", f"part-{n}.csv", f"a,b\n{n},x\n".encode())
    found = delimited.tables_found(spark, str(tmp_path))
    assert list(found) == ["crm_big"] and len(found["crm_big"]) == 1
    assert sorted(r["a"] for r in delimited.read_delimited(spark, found["crm_big"], TWO).collect()) == ["0", "1", "2"]


def test_malformed_lines_are_counted_per_table(spark, tmp_path):
    put(tmp_path / "s_crm", "x.csv", b"a,b\r\n1,a\r\n\r\n2\r\n3,b,c\r\n,\r\n")
    put(tmp_path / "s_crm", "other.csv", b"a\n1,2\n")
    got = delimited.source_line_counts(spark, str(tmp_path), fields={"crm_x": 2}).collect()
    assert {(r["table"], r["rows"], r["malformed"]) for r in got} == {("crm_x", 5, 3), ("crm_other", 1, None)}
