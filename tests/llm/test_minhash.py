"""Near-duplicates by b-bit MinHash against comparing all pairs."""

import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from oreflow.llm import minhash


def brute_set(text, words=4):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not found:
        return set()
    size = min(words, len(found))
    return {" ".join(found[i : i + size]) for i in range(len(found) - size + 1)}


def brute(docs, percent=80):
    """docs: (id, text); the rows' (id, set size, component, kept)."""
    sets = [brute_set(t) for _, t in docs]
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in combinations(range(len(docs)), 2):
        common = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
            parent[root(b)] = root(a)
    least = {}
    for i, (doc, _) in enumerate(docs):
        r = root(i)
        least[r] = doc if least.get(r) is None else least[r] if doc is None else min(least[r], doc)
    return Counter((d, len(sets[i]), least[root(i)], d == least[root(i)]) for i, (d, _) in enumerate(docs))


def near_texts(rng, families, copies, words=60, changes=3):
    out = []
    for _ in range(families):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(words // 2, words * 2))]
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.randrange(changes + 1)):
                own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
            out.append(" ".join(own))
    return out


# Small parts and cells send every bucket and group through the dealing.
@pytest.mark.parametrize("part,cell", [(1 << 11, 1 << 10), (3, 2)])
def test_same_components_as_all_pairs(spark, part, cell):
    rng = random.Random(3)
    texts = near_texts(rng, 12, 9) + near_texts(rng, 5, 4, words=8, changes=1) + ["", "one", "One", "one two", " \n"]
    rng.shuffle(texts)
    docs = list(enumerate(texts)) + [(500, texts[0]), (2, texts[7])]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = Counter(map(tuple, minhash.near_duplicates(df, part=part, cell=cell).collect()))
    assert got == brute(docs)


def test_copies_that_only_their_source_links(spark):
    """Copies that differ from each other by too much, each near the one text they come from, the last by id."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for _ in range(40):
        own = list(base)
        for at in rng.sample(range(30), 3):
            own[at * 4] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(own))
    docs = list(enumerate([*texts, " ".join(base)]))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = brute(docs)
    assert Counter(map(tuple, minhash.near_duplicates(df, part=8, cell=4).collect())) == want
    assert Counter(c for _, _, c, _ in want.elements()).most_common(1)[0][1] > 30


def test_texts_with_a_common_frame_make_no_group(spark):
    """A frame that all share, with a third of their shingles, neither links them nor has them compared."""
    frame = " ".join(f"f{i}" for i in range(60))
    texts = [frame + " " + " ".join(f"t{n}x{i}" for i in range(60)) for n in range(200)]
    least = [minhash.minima(minhash.shingles(t.encode())) for t in texts]
    sign = np.stack([np.frombuffer(minhash.signature(m), np.uint64) for m in least])
    sizes = np.full(len(texts), 117)
    assert minhash.likely(sign, sizes[:, None], sign, sizes, 80)[1].sum() == len(texts)


def test_estimates_are_corrected_for_collisions():
    rng = np.random.default_rng(1)
    for common in (0, 500, 900):
        pairs = []
        for _ in range(60):
            a, b, both = (rng.integers(0, 1 << 63, n, np.uint64) for n in (1000 - common, 1000 - common, common))
            sets = [np.unique(np.concatenate([x, both])) for x in (a, b)]
            signs = [np.frombuffer(minhash.signature(minhash.minima(s)), np.uint64)[None, :] for s in sets]
            pairs.append(minhash.similarity(minhash.agreements(*signs))[0, 0])
        true = common / (2000 - common)
        assert abs(np.mean(pairs) - true) < 0.03
    assert minhash.least_estimate(80) > 0.5


def test_agreements_count_low_bits():
    left, right = (np.random.default_rng(i).integers(0, 1 << 32, minhash.MINIMA, np.uint32) for i in (1, 2))
    signs = [np.frombuffer(minhash.signature(x), np.uint64)[None, :] for x in (left, right)]
    mask = (1 << minhash.BITS) - 1
    assert minhash.agreements(*signs)[0, 0] == int(((left & mask) == (right & mask)).sum())


@pytest.mark.parametrize("left,right,want", [(4, 5, True), (8, 10, True), (79, 100, False), (1, 1, True)])
def test_the_limit_itself_is_a_link(left, right, want):
    sets = [np.arange(n, dtype=np.uint64) for n in (left, right)]
    assert minhash.linked(*sets, 80) is want and minhash.linked(*sets[::-1], 80) is want


def test_odd_rows(odd_docs, no_docs):
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = minhash.near_duplicates(odd_docs)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    none = lambda rows: Counter((d, n, c, True if d is None and c is None else k) for d, n, c, k in rows)
    # Texts without words are components of their own, whatever their id.
    assert none(map(tuple, got.collect())) == none(brute(docs).elements())
    assert minhash.near_duplicates(no_docs).count() == 0
