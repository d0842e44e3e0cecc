import hashlib
import re

import pytest

from oreflow.llm.exact_dedup import PRIMES, chunk_hashes, exact_duplicates, powers


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def expected(rows):
    """(doc_id, sha, group size, keep_id, kept count) by brute force over (doc_id, text)."""
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(plain(text), []).append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    out = []
    for body, members in groups.items():
        best = min(members)
        sha = hashlib.sha256(body.encode()).hexdigest()
        out += [(m[3], best[3], len(members), sha) for m in members]
    return sorted(out, key=str), len(groups)


# The small primes make nearly all fingerprints collide: only the comparison of bytes tells texts apart.
@pytest.mark.parametrize("primes", [PRIMES, (2, 3)])
@pytest.mark.parametrize("chunk", [1 << 16, 7])
def test_odd_rows(odd_docs, primes, chunk):
    got = exact_duplicates(odd_docs.where("doc_id IS NULL OR doc_id <> 5"), primes=primes, chunk=chunk).collect()
    rows = [(r.doc_id, r.text) for r in odd_docs.collect() if r.doc_id != 5]
    want, groups = expected(rows)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == want
    assert sum(r.kept for r in got) == groups
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_empty(no_docs):
    assert exact_duplicates(no_docs).count() == 0


def test_chunk_hashes_combine():
    text = bytes(range(256)) * 30
    for prime, place in zip(PRIMES, (0, 1)):
        whole = [(p, powers(p, 12345, len(text))) for p in PRIMES]
        parts = [(p, powers(p, 12345, 100)) for p in PRIMES]
        one = chunk_hashes(text, whole, len(text))[0][2 * place]
        folded = 0
        for row in chunk_hashes(text, parts, 100):
            folded = (folded * row[2 * place + 1] + row[2 * place]) % prime
        assert folded == one
