import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from oreflow.llm import pu_quality, va_search
from oreflow.llm.line_chunks import dedup_line_chunks
from oreflow.llm.mixing import leaf_quotas, mix, words_of


# ---- search


def brute_top(rows, k, every):
    whole = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            whole.setdefault(i, []).append([math.floor(256 * x) for x in v])
    out = []
    for q in sorted(i for i in whole if i % every == 0):
        own = min(whole[q])
        hits = [(-sum(a * b for a, b in zip(own, v)), i) for i, vs in whole.items() if i != q for v in vs if len(v) == len(own)]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(hits)[:k])]
    return out


@pytest.mark.parametrize("block,query_block", [(4, 2), (4096, 512)])
def test_search(spark, block, query_block):
    rng = random.Random(1)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)]) for i in range(60)]
    rows += [(i, [0.5] * 6) for i in range(60, 90)]  # one very common vector: ties
    rows += [(10, None), (None, [1.0] * 6), (91, [1.0, None] * 3), (92, [float("nan")] * 6), (93, []), (100, [0.1, 0.2])]
    rows += [(110, [0.3, -0.4]), (20, [0.9] * 6), (94, [float("inf")] * 6), (7, rows[7][1])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, block int").repartition(3)
    got = va_search.top_products(df, k=5, every=10, block=block, query_block=query_block)
    assert sorted(map(tuple, got.collect())) == brute_top(rows, 5, 10)
    assert va_search.top_products(df.limit(0)).count() == 0


def test_exact_vectors_are_read_only_where_a_bound_asks(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=24).tolist()) for i in range(1200)]
    vectors = spark.createDataFrame(rows, "vec_id long, vector array<double>")
    classes = va_search._classes(vectors, 5)
    asked = vectors.where("vec_id % 100 = 0")
    scanned = va_search.open_classes(asked, classes, 5, 256, 8).collect()
    read = {q: {r["class"] for r in scanned if r["query_id"] == q} for q in range(0, 1200, 100)}
    assert all(5 <= len(c) <= 40 for c in read.values())
    id_of = {r["class"]: r["members"][0]["vec_id"] for r in classes.collect()}
    for q, _, v, _ in brute_top(rows, 5, 100):
        assert v in {id_of[c] for c in read[q]}


def test_copies_of_a_vector_are_one_class(spark):
    rng = np.random.default_rng(6)
    hot = rng.normal(size=8).tolist()
    rows = [(i, hot if i % 3 else rng.normal(size=8).tolist()) for i in range(900)] + [(0, hot)] * 4 + [(50, hot)] * 9
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    got = va_search.top_products(vectors, block=64, query_block=4)
    assert sorted(map(tuple, got.collect())) == brute_top(rows, 5, 50)
    classes = va_search._classes(vectors.select("vec_id", F.col("embedding").alias("vector")), 5)
    assert classes.count() == 301 and classes.selectExpr("max(size(members))").first()[0] == 6


def test_large_products_are_exact():
    assert va_search.products(np.array([2.0**40, 1.0]), np.array([[2.0**20, 1.0]])) == [2**60 + 1]


# ---- lines

PASSAGE = "\n".join(f"shared line number {i} of a passage" for i in range(12))


def test_shared_passage_goes_once(spark):
    rows = [(i, f"own opening {i}\nown second {i}\n{PASSAGE}\nown end {i}", i) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, chunk int")
    got = {r.doc_id: r.text for r in dedup_line_chunks(docs).collect()}
    assert got[0] == rows[0][1]
    for i in range(1, 6):
        assert f"own opening {i}" in got[i] and f"own end {i}" in got[i]
        assert sum(line.startswith("shared") for line in got[i].split("\n")) <= 6


def test_nothing_else_goes(spark, odd_docs, no_docs):
    rng = random.Random(2)
    clean = [(i, "\n".join(" ".join(rng.choices("abcdefghij", k=9)) for _ in range(8))) for i in range(30)]
    docs = spark.createDataFrame(clean, "doc_id long, text string")
    assert {(r.doc_id, r.text) for r in dedup_line_chunks(docs).collect()} == set(clean)
    got = dedup_line_chunks(odd_docs)
    assert got.columns == odd_docs.columns and got.count() == odd_docs.count()
    texts = {r.doc_id: r.text for r in got.collect()}
    assert texts[1].startswith("one") and texts[2].startswith("one") and texts[3] is None and texts[4] == "" and texts[6] == " \n\t "
    assert dedup_line_chunks(no_docs).count() == 0


def test_what_goes_is_elsewhere(spark):
    """Every removed run of lines stands, byte for byte, in a text that keeps it."""
    rng = random.Random(3)
    lines = [f"line {i} {rng.random()}" for i in range(40)]
    rows = []
    for i in range(40):
        at = rng.randrange(30)
        rows.append((i, "\n".join([f"own {i}", *lines[at : at + rng.randint(2, 10)], f"tail {i}"])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    before, kept, gone = dict(rows), set(), set()
    for r in dedup_line_chunks(docs, removed="removed").collect():
        own = before[r.doc_id].split("\n")
        cut = {n for m in r.removed or [] for n in range(m.first, m.first + m.size)}
        assert r.text == "\n".join(x for n, x in enumerate(own) if n not in cut)
        kept |= {x for n, x in enumerate(own) if n not in cut}
        gone |= {x for n, x in enumerate(own) if n in cut}
    assert gone and gone <= kept


# ---- mixing


def test_shortages_go_to_siblings_first(spark):
    supply = spark.createDataFrame(
        [("a", "x", "1", 10), ("a", "x", "2", 1000), ("a", "y", "3", 1000), ("b", "x", "4", 20)],
        "domain string, lang string, source string, tokens long",
    )
    one = [F.lit(1)] * 3
    got = {r.source: r.quota for r in leaf_quotas(supply, ["domain", "lang", "source"], one, 400, epochs=1).collect()}
    # b can give 20 of its 200, so a gets 380: 190 for each language, and "2" makes up for "1".
    assert got == {"1": 10, "2": 180, "3": 190, "4": 20}


def test_mix_takes_prefixes_of_epochs(spark, odd_docs, no_docs):
    rows = [(i, "w " * (1 + i % 7), "en" if i % 3 else None, f"s{i % 2}", 0) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, tokens int")
    levels = [F.lit("d"), F.col("lang"), F.col("source")]
    weights = lambda names, tokens: [F.lit(1), F.lit(1), F.when(names[2] == "=s0", 5).otherwise(1)]
    out = mix(docs, levels, weights, words_of(F.col("text")), share=0.9)
    assert out.columns == [*docs.columns, "copies"]
    got = out.collect()
    assert len(got) == 400
    taken = {}
    for r in got:
        n = 1 + r.doc_id % 7
        t = taken.setdefault((r.lang, r.source), [0, 0, set()])
        t[0] += n * r.copies
        t[1] += n
        t[2].add(r.copies)
    total = sum(t[1] for t in taken.values())
    want = {}
    for lang in (None, "en"):
        budget = 0.45 * total
        caps = {s: 4 * taken[lang, s][1] for s in ("s0", "s1")}
        s0 = min(caps["s0"], max(budget * 5 / 6, budget - caps["s1"]))
        want[lang, "s0"], want[lang, "s1"] = s0, min(caps["s1"], budget - s0)
    for leaf, (tokens, _, copies) in taken.items():
        assert want[leaf] - 1 <= tokens <= want[leaf] + 7 and max(copies) - min(copies) <= 1
    odd = mix(odd_docs, levels, weights, words_of(F.col("text")), share=1.0)
    assert odd.count() == odd_docs.count()
    assert mix(no_docs, levels, weights, words_of(F.col("text")), share=1.0).count() == 0


# ---- quality


def test_prior_and_ranking():
    rng = np.random.default_rng(0)
    width = pu_quality.FEATURES
    good = lambda n: np.pad(rng.normal(1, 1, (n, 3)), ((0, 0), (0, width - 3))).astype(np.float32)
    bad = lambda n: np.pad(rng.normal(-3, 1, (n, 3)), ((0, 0), (0, width - 3))).astype(np.float32)
    model = pu_quality.fit(good(1000), np.concatenate([good(700), bad(300)]))
    assert 0.6 < model.prior < 0.85
    assert (model.scores(good(200)) > 0.3).mean() > 0.95 and (model.scores(bad(200)) < 0.3).mean() > 0.9


def test_scores_of_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (5, None, 1), (None, 1, 0), (6, 0, 0)], "doc_id long, quality int, toxic int")
    got = pu_quality.classify(odd_docs, labels).collect()
    assert len(got) == odd_docs.count() and all(0 <= r.score <= 1 for r in got)
    assert all(r.predicted == (r.score >= 0.3) for r in got)
    assert pu_quality.classify(no_docs, labels).count() == 0
    assert pu_quality.keep_good(odd_docs, labels.limit(0)).count() == odd_docs.count()


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    out = pu_quality.classify(docs, labels).where("held_out").join(labels, "doc_id")
    right = out.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")).alias("right")).first().right
    assert right > 0.95


def test_long_text_features_equal_short_ones():
    text = b"Some words, and more! \xc3\xa9 12\n"
    many = text * 12_000
    one, all_ = pu_quality.features([text * 3, many])
    assert np.allclose(one[:1500], all_[:1500], atol=0.05)
