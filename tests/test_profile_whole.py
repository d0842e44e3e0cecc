from collections import Counter

import pyarrow.parquet as pq

from oreflow.workload.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_every_column_of_lineitem_is_profiled(spark):
    table = pq.read_table(f"{SF}/lineitem.parquet")
    got = {r.column: r.top_values for q in ("profile_top3", "profile_top3_measures") for r in QUERIES[q](spark, SF).collect()}
    assert got.keys() == set(table.column_names)
    for name, kind in zip(table.schema.names, table.schema.types):
        values = table[name].to_pylist()
        if str(kind) == "double":
            values = [f"{v:.6f}" for v in values]
        elif str(kind).startswith("timestamp"):
            values = [v.strftime("%Y-%m-%d %H:%M:%S.%f") for v in values]
        counts = sorted(Counter(map(str, values)).items(), key=lambda x: (-x[1], x[0]))
        assert got[name] == ", ".join(f"{v}({n})" for v, n in counts[:3])
