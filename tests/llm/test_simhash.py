import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash

from oreflow.llm import simhash
from oreflow.llm.components import components


def test_masks_cover_every_pair_within_the_radius():
    masks = simhash.covering_masks()
    assert len(masks) == 15
    for size in (1, 2, 3):
        for bits in combinations(range(64), size):
            flipped = sum(1 << b for b in bits)
            assert any(not flipped & m for m in masks)


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", ["", " \n", "One", "A b", "A b C", "É x y z É x", "a b c d e " * 40])
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) == brute_print(text)


def brute_components(values):
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in combinations(sorted(parent), 2):
        if (a ^ b).bit_count() <= 3:
            parent[max(root(a), root(b))] = min(root(a), root(b))
    return {v: root(v) for v in values}


# The low limit sends every bucket of two through the second dealing; the low COMPARED makes it look values up.
@pytest.mark.parametrize("limit,compared", [(1 << 16, 1 << 11), (1, 1 << 11), (1 << 16, 3)])
def test_links_connect_all_near_pairs(spark, monkeypatch, limit, compared):
    monkeypatch.setattr(simhash, "COMPARED", compared)
    rng = random.Random(5)
    values = set()
    for _ in range(12):
        at = rng.getrandbits(64)
        for _ in range(rng.randint(1, 8)):
            values.add(at)
            for b in rng.sample(range(64), rng.randint(0, 4)):
                at ^= 1 << b
    df = spark.createDataFrame([(simhash.signed(v),) for v in values], "fp long")
    links = simhash.near_links(df, limit=limit)
    got = {r.a: r.b for r in components(links).collect()}
    want = brute_components(values)
    for a, b in combinations(values, 2):
        same = got.get(simhash.signed(a), simhash.signed(a)) == got.get(simhash.signed(b), simhash.signed(b))
        assert same == (want[a] == want[b])


def test_components_of_a_long_path(spark):
    edges = spark.range(200).selectExpr("id AS a", "id + 1 AS b").union(spark.createDataFrame([(900, 900), (901, 902)], "a long, b long"))
    got = {r.a: r.b for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 201)}, 902: 901}


def test_odd_rows(odd_docs, no_docs):
    got = simhash.near_duplicates(odd_docs).collect()
    rows = [(r.doc_id, brute_print(r.text or "")) for r in odd_docs.collect()]
    roots = brute_components({f for _, f in rows})
    least = {}
    for doc_id, f in rows:
        if doc_id is not None:
            least[roots[f]] = min(doc_id, least.get(roots[f], doc_id))
    want = sorted((str(d), f"{f:016x}", least.get(roots[f])) for d, f in rows)
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in got) == want
    assert simhash.near_duplicates(no_docs).count() == 0
    kept = simhash.keep_first(odd_docs).collect()
    assert len(kept) == len(set(roots.values())) and {r.doc_id for r in kept} >= set(least.values())
    assert simhash.keep_first(no_docs).count() == 0


def test_forest_is_small():
    values = np.sort(np.array([1 << b for b in range(20)], np.uint64))
    assert sum(len(a) for a, _ in simhash._forest(values, 0, 3)) == 19
