import time

import pytest

from oreflow.llm.chat_format import format_conversations, read_back

TURNS = [
    (1, 0, "system", "be <s>good</s> [x] \\b \\\\"),
    (1, 1, "user", "hi"),
    (1, 2, "user", "[+] again </s>"),
    (1, 3, "assistant", "a\\"),
    (1, 4, "assistant", "[INST]\\l"),
    (1, 4, "assistant", "[INST]\\l"),
    (2, None, None, None),
    (2, 0, "", ""),
    (2, 1, "assist]ant[", "x"),
    (None, 0, "assistant", "lost"),
    (3, 5, "assistant", ""),
]


@pytest.fixture(scope="module")
def turns(spark):
    return spark.createDataFrame([(*t, 0) for t in TURNS], "conv_id long, turn long, role string, text string, turns int")


def test_round_trip(turns):
    got = {r.conv_id: r for r in read_back(format_conversations(turns)).collect()}
    by_conversation = {}
    for conv, turn, role, text in TURNS:
        by_conversation.setdefault(conv, []).append(((turn is not None, turn or 0), (role is not None, role or ""), text or "", role))
    assert got.keys() == by_conversation.keys()
    for conv, rows in by_conversation.items():
        rows = sorted(rows)
        assert [(t.role, t.text) for t in got[conv].turns] == [(r[3], r[2]) for r in rows]
        assert got[conv].learned == "".join(r[2] for r in rows if r[3] == "assistant")


def test_neighbours_share_a_block(turns):
    row = format_conversations(turns).where("conv_id = 1").first()
    assert row.formatted.count("</s>") == 3 and row.formatted.count("[+]") == 3
    assert row.formatted.startswith("[system]")


def test_empty(turns):
    assert format_conversations(turns.limit(0)).count() == 0


def by_hand(rows):
    """Formatted text and loss spans of one conversation's (role, text) rows, in order, plain names and texts only."""
    text, spans = "", []
    for i, (role, said) in enumerate(rows):
        text += f"[{role}]" if i == 0 or rows[i - 1][0] != role else "[+]"
        if role == "assistant":
            spans.append((len(text), len(said)))
        text += said
        if i + 1 == len(rows) or rows[i + 1][0] != role:
            text += "</s>"
    return text, spans


@pytest.mark.parametrize("count", [1, 2, 3, 4, 5, 7, 8, 9, 63, 64, 65])
def test_spans_by_hand(spark, count):
    rows = [("assistant" if i % 3 else "user", "\U0001f600é" * (i % 5) + str(i)) for i in range(count)]
    data = [(7, i, *row) for i, row in enumerate(rows)]
    got = format_conversations(spark.createDataFrame(data, "conv_id long, turn long, role string, text string")).first()
    assert (got.formatted, [tuple(s) for s in got.loss_spans]) == by_hand(rows)


@pytest.mark.parametrize("roles", [["user", "assistant"], ["assistant"], ["user", "user", "assistant", "assistant"]])
def test_work_grows_with_the_turns(spark, roles):
    """32,000 turns of one conversation, one block or many: spans and learned text in one pass each."""
    turns = spark.range(32_000).selectExpr(
        "1 AS conv_id", "id AS turn",
        f"array({', '.join(map(repr, roles))})[cast(id % {len(roles)} AS int)] AS role", "'tränslate [this] ' || id AS text",
    )
    began = time.perf_counter()
    got = read_back(format_conversations(turns)).first()
    taken = time.perf_counter() - began
    rows = [(roles[i % len(roles)], f"tränslate [this] {i}") for i in range(32_000)]
    assert [tuple(t) for t in got.turns] == rows
    assert got.learned == "".join(text for role, text in rows if role == "assistant")
    assert taken < 20
