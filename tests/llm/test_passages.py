"""Shared runs of lines with over 50 words, of any number of lines, against all runs found by brute force."""

import random

from oreflow.llm.line_chunks import dedup_line_chunks, passages_of


def shared_runs(texts):
    """Runs of lines over 50 words, shortest from each start, that stand in several of these distinct texts."""
    seen = {}
    for n, text in enumerate(set(texts)):
        lines = text.split("\n")
        for a in range(len(lines)):
            words = 0
            for b in range(a, len(lines)):
                words += len(lines[b].split())
                if words > 50:
                    if lines[a].split():
                        seen.setdefault("\n".join(lines[a : b + 1]), set()).add(n)
                    break
    return [body for body, where in seen.items() if len(where) > 1]


def line(rng, n):
    return " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))


def test_short_runs_and_single_lines_go_whole(spark):
    rng = random.Random(8)
    passages = [[line(rng, 60)], [line(rng, 30), line(rng, 30)], [line(rng, 20), "", line(rng, 20), line(rng, 3), line(rng, 20)]]
    passages += [[line(rng, 5) for _ in range(14)], [line(rng, 200), line(rng, 1)]]
    rows = []
    for i in range(30):
        text = [line(rng, 8)]
        for passage in rng.sample(passages, 2):
            text += [*passage, line(rng, 7)]
        rows.append((i, "\n".join(text)))
    got = {r.doc_id: r.text for r in dedup_line_chunks(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert shared_runs([t for _, t in rows]) and not shared_runs(got.values())
    for passage in passages:
        body = "\n".join(passage)
        holders = [i for i, t in rows if body in t]
        assert body in got[holders[0]] and len(holders) > 1
        for i in holders[1:]:
            assert not {x for x in passage if x} & set(got[i].split("\n"))
    own = lambda t: [x for x in t.split("\n") if len(x.split()) in (7, 8)]
    assert all(own(got[i]) == own(t) for i, t in rows)


def test_repeats_in_one_text_keep_the_first_whole(spark):
    text = "\n".join(["same six words on every line"] * 40)
    docs = spark.createDataFrame([(1, text), (2, "x\n" + text)], "doc_id long, text string")
    rows = {r.doc_id: r for r in dedup_line_chunks(docs, removed="removed").collect()}
    assert len(rows[1].text.split()) > 50 and rows[2].text.startswith("x") and len(rows[2].text.split()) < 50
    for r in rows.values():
        spans = [(m.first, m.first + m.size) for m in r.removed]
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_runs_are_the_shortest():
    text = b"\n".join([b"a " * 30, b"", b"b " * 21, b"c", b"d " * 51])
    assert [(f, n) for f, n, _ in passages_of(text)] == [(0, 3), (0, 4), (2, 3), (3, 2), (4, 1)]
    assert passages_of(b"a " * 50) == [] and len(passages_of(b"a " * 51)) == 1 and passages_of(b"") == []
