"""The stages of the pipeline, each on what the one before it kept, against plain versions."""

from collections import Counter
from itertools import combinations

import pytest

import corpus_pipeline
from oreflow.llm.simhash import fingerprint
from oreflow.session import written

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], SF)))
    return out


def test_columns(stages):
    for docs in stages[1:-1]:
        assert docs.columns == stages[0].columns


def test_quality_and_lines_keep_whole_rows(stages):
    before, kept, lines = ({r.doc_id: r for r in docs.collect()} for docs in stages[:3])
    assert 0 < len(kept) < len(before) and all(kept[i] == before[i] for i in kept)
    assert lines.keys() == kept.keys() and all(set(lines[i].text.split("\n")) <= {*kept[i].text.split("\n"), ""} for i in lines)


def test_one_document_of_each_group_stays(stages):
    prints = {r.doc_id: fingerprint((r.text or "").encode()) for r in stages[2].collect()}
    parent = {i: i for i in prints}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in combinations(sorted(prints), 2):
        if (prints[a] ^ prints[b]).bit_count() <= 3:
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    assert sorted(r.doc_id for r in stages[3].collect()) == sorted({root(i) for i in prints})


def test_mixture_takes_known_documents_and_the_budget(stages):
    words = lambda rows: sum(max(1, len((r.text or "").split())) for r in rows)
    before, mixed = stages[3].collect(), stages[4].collect()
    assert {r for r in mixed} <= {r for r in before}
    # A leaf of the tree goes over its quota by less than one of its documents.
    leaves = {}
    for r in before:
        leaf = leaves.setdefault((r.lang, r.source), [])
        leaf.append(words([r]))
    assert 0 <= words(mixed) - words(before) <= sum(map(max, leaves.values()))


def test_every_row_of_the_mixture_is_packed_once(stages):
    spans = {}
    for r in stages[5].collect():
        spans.setdefault((r.doc_id, r["copy"]), []).append((r.start, r.length, r.doc_tokens))
    for pieces in spans.values():
        at = 0
        for start, length, total in sorted(pieces):
            assert start == at
            at += length
        assert at == pieces[0][2]
    assert Counter(d for d, _ in spans) == Counter(r.doc_id for r in stages[4].collect())


def test_run_packs_the_same_documents(spark, stages):
    docs = lambda df: Counter(r.doc_id for r in df.where("start = 0").collect())
    assert docs(corpus_pipeline.run(spark, SF)) == docs(stages[5])
