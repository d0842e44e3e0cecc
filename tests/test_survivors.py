import datetime
import random
from collections import Counter

import pytest

from oreflow.operators.survivors import survivors

D = datetime.date.fromisoformat
SCHEMA = "row int, id int, key string, a string, b string, c string, date date"

# row, id, key, number of NULLs, date
EDGE = [
    (1, None, "A", 0, "2025-01-01"), (2, 11, "B", 1, None), (3, 12, "C", 1, "2025-02-01"),
    (4, 13, "C", 0, "2025-01-01"), (5, 14, "D", 1, "2025-01-01"), (6, 15, "D", 1, "2025-03-01"),
    (7, 16, "E", 0, "2025-01-01"), (8, 17, "E", 0, "2025-01-01"), (9, None, "F", 0, "2025-01-01"),
    (10, 18, "F", 2, "2025-01-01"), (11, 19, "G", 0, None), (12, 20, "G", 1, "2025-01-01"),
    (13, 21, None, 0, "2025-01-01"), (14, 22, None, 3, "2025-05-01"), (15, 23, "H", 0, "2025-01-01"),
    (16, 24, "H", 3, "2025-09-01"),
]
KEPT = {2, 4, 6, 7, 8, 13, 15}


def record(row, rid, key, nulls, date):
    return (row, rid, key, *["x" if i >= nulls else None for i in range(3)], date and D(date))


def kept(rows, records):
    df = rows(records, SCHEMA).repartition(3)
    out = survivors(df, "key", "id", "date", ["a", "b", "c"])
    assert out.columns == df.columns
    return Counter(r["row"] for r in out.collect())


def test_edge_rows(rows):
    assert kept(rows, [record(*e) for e in EDGE]) == Counter(KEPT)


def by_hand(records):
    groups = {}
    for r in records:
        groups.setdefault(r[2], []).append(r)
    out = []
    for group in groups.values():
        if len(group) == 1:
            out += [r[0] for r in group if r[1] is not None]
            continue
        least = min(r[3:6].count(None) for r in group)
        fullest = [r for r in group if r[3:6].count(None) == least and r[1] is not None and r[6] is not None]
        out += [r[0] for r in fullest if r[6] == max(f[6] for f in fullest)]
    return Counter(out)


@pytest.mark.parametrize("seed", [0, 2, 1000])
def test_like_brute_force(rows, seed):
    draw = random.Random(seed).choice
    data = [
        record(i, draw([None, 1, 2]), draw([None, *map(str, range(150))]), draw([0, 1, 2, 3]),
               draw([None, "2025-01-01", "2025-02-01"]))
        for i in range(600)
    ]
    assert kept(rows, data) == by_hand(data)


def test_a_group_of_identical_copies_is_kept_whole(rows):
    data = [record(i, 5, "hot", 0, "2025-01-01") for i in range(300)] + [record(999, 6, "cold", 0, None)]
    assert sum(kept(rows, data).values()) == 301
