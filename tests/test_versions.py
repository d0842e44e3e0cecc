import datetime
import random
from collections import Counter

import pytest

from oreflow.operators.versions import chain_end_dates, version_join

D = datetime.date.fromisoformat
DAY = datetime.timedelta(days=1)
BASE = D("2020-01-01")
CHAIN = "id int, key string, start date, end date"

# id, key, start, end, expected end
EDGE = [
    (1, "X", "2020-01-01", "2019-01-01", "2020-12-31"), (2, "X", "2021-01-01", "2019-01-01", "2021-12-31"),
    (3, "X", "2022-01-01", None, None), (4, "Y", "2022-01-01", "2019-01-01", "2019-12-31"),
    (5, "Y", "2020-01-01", "2020-06-30", "2020-06-30"), (6, "Z", "2020-01-01", None, "2020-12-31"),
    (7, "Z", "2021-01-01", None, None),
]
USUAL, MIXED = {}, dict(slice_bits=11)
PATHS = [USUAL, MIXED, dict(slice_bits=16)]


def date(text):
    return text and D(text)


@pytest.mark.parametrize("path", PATHS)
def test_chain_edge_rows(rows, path):
    data = [(i, k, date(s), date(e)) for i, k, s, e, _ in EDGE] + [(None, "X", D("1999-01-01"), None)]
    out = chain_end_dates(rows(data, CHAIN), "key", "id", "start", "end", **path)
    assert {r["id"]: r["end"] for r in out.collect()} == {e[0]: date(e[4]) for e in EDGE}
    assert out.count() == len(EDGE)


def some_day(rnd, last):
    return None if rnd.random() < 0.15 else BASE + rnd.randint(0, last) * DAY


# The spacing of the ids puts several of them into a slice and several slices into the next one.
@pytest.mark.parametrize(
    "id_type, spacing, path",
    [("int", 1, USUAL), ("int", 2**19, USUAL), ("int", 2**9, MIXED), ("bigint", 2**40, USUAL), ("bigint", 1, USUAL)],
)
def test_chain_like_brute_force(rows, id_type, spacing, path):
    rnd = random.Random(str(path))
    data = [
        (i * spacing, rnd.choice([None, *map(str, range(60))]), some_day(rnd, 300), some_day(rnd, 300))
        for i in rnd.sample(range(-400, 400), 400)
    ]
    expected = {}
    for i, k, s, e in data:
        later = sorted((r for r in data if r[1] == k and r[0] > i), key=lambda r: r[0])
        following = later[0][2] - DAY if later and later[0][2] else None
        expected[i] = following if e is None or (s is not None and s > e) else e
    df = rows(data, CHAIN.replace("id int", f"id {id_type}"))
    got = {r["id"]: r["end"] for r in chain_end_dates(df, "key", "id", "start", "end", **path).collect()}
    assert got == expected


@pytest.mark.parametrize("path", PATHS)
def test_copies_of_a_version_all_end_before_the_next(rows, path):
    data = [(1, "k", D("2020-01-01"), None)] * 50 + [(2, "k", D("2021-01-01"), None)] * 50
    out = chain_end_dates(rows(data, CHAIN), "key", "id", "start", "end", **path)
    assert Counter((r["id"], r["end"]) for r in out.collect()) == {(1, D("2020-12-31")): 50, (2, None): 50}


@pytest.mark.parametrize("path", PATHS)
def test_copies_start_at_the_earliest_known_start(rows, path):
    data = [(1, "a", D("2020-01-01"), None), (2, "a", None, None), (2, "a", D("2021-01-01"), None), (3, "a", D("2022-01-01"), None)]
    out = chain_end_dates(rows(data, CHAIN), "key", "id", "start", "end", **path)
    assert Counter((r["id"], r["end"]) for r in out.collect()) == {(1, D("2020-12-31")): 1, (2, D("2021-12-31")): 2, (3, None): 1}


FACTS = "row int, key string, day date"
VERSIONS = "vid int, vkey string, since date, until date"


def look_up(rows, facts, versions, **path):
    out = version_join(rows(facts, FACTS), rows(versions, VERSIONS), "key", "day", "vkey", "since", "until", ["vid"], **path)
    assert out.columns == ["row", "key", "day", "vid"]
    return Counter((r["row"], r["vid"]) for r in out.collect())


def look_up_by_hand(facts, versions):
    out = Counter()
    for row, key, day in facts:
        hits = [
            v for v, k, s, u in versions
            if key is not None and key == k and day and s and s <= day and (u is None or day <= u)
        ]
        out.update([(row, v) for v in hits] or [(row, None)])
    return out


@pytest.mark.parametrize("keys, span", [(40, 90), (2, 90), (3, 5), (1, 20000)])
def test_version_join_like_brute_force(rows, keys, span):
    rnd = random.Random(keys)
    keys = [None, *map(str, range(keys))]
    facts = [(i, rnd.choice([*keys, "unknown"]), some_day(rnd, span)) for i in range(300)]
    versions = [(i, rnd.choice(keys), some_day(rnd, span), some_day(rnd, span)) for i in range(150)]
    assert look_up(rows, facts, versions) == look_up_by_hand(facts, versions)


def test_dates_before_1970_and_far_ends(rows):
    facts = [(1, "k", D("1960-03-05")), (2, "k", D("2024-03-05")), (3, "other", D("2024-03-05")), (4, "k", D("1899-12-31"))]
    versions = [(1, "k", D("1900-01-01"), D("1960-03-05")), (2, "k", D("1960-03-06"), None)]
    assert look_up(rows, facts, versions) == {(1, 1): 1, (2, 2): 1, (3, None): 1, (4, None): 1}


def test_listings_are_bounded_where_versions_overlap(rows):
    versions = [(i, "k", datetime.date(2020, 1, 1) + datetime.timedelta(days=i), None) for i in range(1000)]
    out = version_join(
        rows([(1, "k", D("2020-01-10"))], FACTS), rows(versions, VERSIONS), "key", "day", "vkey", "since", "until", ["vid"]
    )
    assert sorted(r["vid"] for r in out.collect()) == list(range(10))
