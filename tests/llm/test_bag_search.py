"""Search by classes of equal bags against scoring every document by itself."""

import math
import random
import re
from collections import Counter

import pytest

from oreflow.llm.bag_search import rank_documents, terms_of

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, top=20):
    bags = [(i, Counter(plain_terms(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    count, terms = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    asked = {}
    for i, t in items:
        asked.setdefault(i, []).extend(plain_terms(t))
    out = []
    for item, words in asked.items():
        scored = []
        for doc, bag in bags:
            m = 75 + (25 * sum(bag.values()) * count) // terms
            score = 0
            for w in words:
                if tf := bag[w]:
                    weight = math.floor(1000 * math.log((2 * count + 2) / (2 * df[w] + 1)))
                    score += weight * ((10**9 * tf) // (1000 * tf + 12 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        for rank, (score, _, _, doc) in enumerate(sorted(scored, key=lambda s: s[:3])[:top], 1):
            out.append((item, rank, doc, -score))
    return Counter(out)


def run(spark, docs, items, **settings):
    docs = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    items = spark.createDataFrame(items, "item_id long, text string")
    return Counter(map(tuple, rank_documents(docs, items, **settings).collect()))


@pytest.mark.parametrize("text", ["Ab,c é’x 12-3", "\x00a\x7fb\x80c", "", "İSTANBUL ÀB"])
def test_terms_are_the_pattern_s(text):
    assert [t.decode() for t in terms_of(text.encode())] == plain_terms(text)


def test_same_as_scoring_every_document(spark):
    rng = random.Random(5)
    words = [f"w{int(rng.paretovariate(0.7)) % 60}" for _ in range(400)]
    texts = [" ".join(rng.choices(words, k=rng.randrange(0, 12))) for _ in range(120)]
    docs = [(rng.randrange(500), rng.choice(texts)) for _ in range(300)]
    items = [(i, " ".join(rng.choices(words, k=6))) for i in range(12)]
    for top in (20, 3):
        assert run(spark, docs, items, top=top) == brute(docs, items, top)


def test_one_class_holds_a_third_of_all_rows(spark):
    docs = [(i, "apple pie") for i in range(100, 0, -1)] + [(i, f"apple tree number {i}") for i in range(200, 400)]
    items = [(0, "pie"), (1, "apple number 333"), (2, "nothing here"), (3, "pie pie tree")]
    got = run(spark, docs, items)
    assert got == brute(docs, items)
    assert [d for i, _, d, _ in sorted(got) if i == 0] == list(range(1, 21))


def test_odd_rows(spark, odd_docs, no_docs):
    items = [(0, "one TWO three"), (0, "salad"), (1, None), (None, "ünïcödé"), (2, ""), (3, "word")]
    asked = spark.createDataFrame([(*r, 9, "x") for r in items], "item_id long, text string, doc_id int, score string")
    got = Counter(map(tuple, rank_documents(odd_docs, asked).collect()))
    assert got == brute([(r.doc_id, r.text) for r in odd_docs.collect()], items)
    assert rank_documents(no_docs, asked).count() == 0
    assert rank_documents(odd_docs, asked.limit(0)).count() == 0
