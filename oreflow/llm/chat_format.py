"""Chat conversations as one training text with a loss mask, by Spark expressions only.

A block of turns of one role is ``[role]`` + its turns, parted by ``[+]``, + ``</s>``.  In roles and texts the
characters that control strings are made of are replaced, so no mark can occur inside them and reading back
is a plain split.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.llm.common import column

END = "</s>"
NEXT = "[+]"
NO_ROLE = "\\e"
# Escapes, in the order they are put in; the reverse order takes them out.
ESCAPES = (("\\", "\\b"), ("[", "\\l"), ("]", "\\r"), ("<", "\\a"))


def escaped(text: Column) -> Column:
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is worked out once however often the body's own lambdas use it."""
    return F.transform(F.array(value), body)[0]


def _running(sums: Column) -> Column:
    """Running sums of an array of numbers; the part summed up doubles each step, so n log n in all."""
    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(F.size(sums), F.lit(2)))).cast("int"))

    def doubled(acc: Column, step: Column) -> Column:
        reach = F.least(F.pow(F.lit(2), step).cast("int"), F.size(acc))
        ahead = F.concat(F.array_repeat(F.lit(0), reach), F.slice(acc, F.lit(1), F.size(acc) - reach))
        return F.zip_with(acc, ahead, lambda a, b: a + b)

    return F.aggregate(steps, sums, doubled)


def format_conversations(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    learned: str = "assistant",
) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans (start and length in code points).

    Turns are in order of turn, role, text, nulls first.  Neighbours of the same role share a block, in
    which each turn keeps its own span.  A null text counts as empty; a null role is a role of its own and
    never learned; rows with a null conversation id form one conversation; other columns are not read.  No
    rows, no conversations.  The loss spans are those of the texts of role ``learned``.
    """
    one = F.struct(
        column(turn).alias("turn"),
        column(role).cast("string").alias("role"),
        F.coalesce(column(text).cast("string"), F.lit("")).alias("text"),
    )
    ordered = turns.groupBy(column(conversation).alias("conv_id")).agg(F.sort_array(F.collect_list(one)).alias("turns"))
    # What goes before and after each turn, by its neighbours.
    neighbours = F.transform(
        "turns",
        lambda t, i: F.struct(
            t["role"].alias("role"),
            escaped(t["text"]).alias("text"),
            ((i == 0) | ~t["role"].eqNullSafe(F.get("turns", i - 1)["role"])).alias("first"),
            ((i == F.size("turns") - 1) | ~t["role"].eqNullSafe(F.get("turns", i + 1)["role"])).alias("last"),
        ),
    )
    name = lambda r: F.when(r.isNull(), "").when(r == "", NO_ROLE).otherwise(escaped(r))
    pieces = F.transform(
        "turns",
        lambda t: F.struct(
            F.when(t["first"], F.concat(F.lit("["), name(t["role"]), F.lit("]"))).otherwise(F.lit(NEXT)).alias("open"),
            t["text"].alias("text"),
            F.when(t["last"], F.lit(END)).otherwise(F.lit("")).alias("close"),
            F.coalesce(t["role"] == learned, F.lit(False)).alias("learned"),
        ),
    )
    # Running length: each turn's text ends where everything up to it, but for what closes it, ends.
    measured = F.transform(
        "turns",
        lambda t: F.struct(
            (F.length(t["open"]) + F.length(t["text"]) + F.length(t["close"])).alias("whole"),
            (F.length(t["text"]) + F.length(t["close"])).alias("from_text"),
            F.length(t["text"]).alias("length"),
            t["learned"].alias("learned"),
        ),
    )
    ended = lambda turns: _running(F.transform(turns, lambda t: t["whole"]))
    placed = _bound(
        measured,
        lambda turns: F.zip_with(
            turns,
            ended(turns),
            lambda t, end: F.struct(
                t["learned"].alias("learned"),
                F.struct((end - t["from_text"]).alias("start"), t["length"].alias("length")).alias("span"),
            ),
        ),
    )
    spans = F.transform(F.filter(placed, lambda p: p["learned"]), lambda p: p["span"])
    return (
        ordered.withColumn("turns", neighbours)
        .withColumn("turns", pieces)
        .select(
            "conv_id",
            F.array_join(
                F.transform("turns", lambda t: F.concat(t["open"], t["text"], t["close"])), ""
            ).alias("formatted"),
            spans.alias("loss_spans"),
        )
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, turns (role, text) and learned text from the output of ``format_conversations`` alone.

    Spans are cut from the text at four bytes a code point, where any place is reached at once; a formatted text has to
    stay below 2^29 code points for that.
    """
    # The last part, behind the last end, is empty.
    blocks = _bound(F.split("formatted", END), lambda b: F.slice(b, F.lit(1), F.size(b) - 1))

    def turns_of(block: Column) -> Column:
        # The part before the first bracket is empty; the first turn follows the role, the others a "+".
        parts = F.filter(F.split(block, "\\["), lambda _, i: i > 0)

        def read(parts: Column) -> Column:
            code = F.substring_index(parts[0], "]", 1)
            role = F.when(code == "", F.lit(None)).when(code == NO_ROLE, F.lit("")).otherwise(unescaped(code))
            return _bound(
                role,
                lambda role: F.transform(
                    parts,
                    lambda p: F.struct(
                        role.alias("role"),
                        unescaped(F.substring(p, F.locate("]", p) + 1, F.length(p))).alias("text"),
                    ),
                ),
            )

        return _bound(parts, read)

    masked = _bound(
        F.encode("formatted", "UTF-32"),
        lambda wide: F.transform(
            "loss_spans", lambda s: unescaped(F.decode(F.substring(wide, s["start"] * 4 + 1, s["length"] * 4), "UTF-32"))
        ),
    )
    return formatted.select(
        "conv_id",
        F.flatten(F.transform(blocks, turns_of)).alias("turns"),
        F.array_join(masked, "").alias("learned"),
        "formatted",
    )
