"""Column rules on the hand-made edge rows."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from oreflow.functions import codes, text, values

D = datetime.date.fromisoformat


def apply(rows, rule, inputs):
    df = rows([(i, x) for i, x in enumerate(inputs)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(rule(F.col("x"))).collect()]


def last(c):
    return text.clean_last_field(c)


CASES = {
    "clean": (text.clean, [(" a b ", "a b"), ("   ", None), ("", None), (None, None), ("\ta", "\ta")]),
    "clean_last_field": (last, [("x\r", "x"), (" x \r", "x"), ("\r", None), (" \r ", None), ("\rx", "x")]),
    "clip": (lambda c: text.clip(c, 3), [("abcdef", "abc"), ("ab", "ab"), (None, None)]),
    "sentence_case": (text.sentence_case, [("mARY-ann", "Mary-ann"), ("de la cruz", "De la cruz"), ("x", "X"), (None, None)]),
    "marital": (
        lambda c: codes.label_or_other(text.clean(c), codes.MARITAL_STATUS),
        [("M", "Married"), ("married", "Married"), ("s", "Single"), ("D", "Other"), (" ", None)],
    ),
    "gender": (
        lambda c: codes.label_or_other(last(c), codes.GENDER),
        [("m", "Male"), ("FEMALE", "Female"), ("u", "Other"), ("F\r", "Female"), (None, None)],
    ),
    "line": (
        lambda c: codes.label_or_other(text.clean(c), codes.PRODUCT_LINE),
        [("M", "Mountain"), ("R", "Road"), ("T", "Touring"), ("S", "Miscellaneous"), ("Q", "Other"), ("", None)],
    ),
    "country": (
        lambda c: codes.label_or_other(last(c), codes.COUNTRY),
        [("usa", "United States"), ("UK", "United Kingdom"), ("GB", "United Kingdom"), ("DE\r", "Germany"),
         ("Narnia", "Other"), ("\r", None), ("au", "Australia"), ("Canada", "Canada"), ("fr", "France")],
    ),
    "yes_no": (
        lambda c: codes.label_or_null(last(c), codes.YES_NO),
        [("y", "Yes"), ("NO\r", "No"), ("maybe", None), (None, None)],
    ),
    "category": (codes.category_of, [("CO-PE-PD-M282", "CO_PD"), ("CO-RF-FR", "CO_RF"), (None, None)]),
    "product_key": (lambda c: text.tail(c, 7), [("CO-PE-PD-M282", "PD-M282"), ("CO-PE", "")]),
    "from_first": (
        lambda c: text.from_first(c, "AW"),
        [("NASAW00011000", "AW00011000"), ("AW1AW2", "AW1AW2"), ("11000", None), (None, None)],
    ),
    "without_prefix": (lambda c: text.without_prefix(c, "SO"), [("SO43697", "43697"), ("43697", "43697"), ("so1", "so1")]),
    "compact_date": (
        values.compact_date,
        [("20101229", D("2010-12-29")), ("0", None), ("20241340", None), ("5489", None), (None, None), ("abcdefgh", None)],
    ),
    "to_int": (values.to_int, [("12", 12), ("12.5", None), ("", None), ("x", None), ("99999999999", None)]),
    "to_date": (values.to_date, [("2024-01-31", D("2024-01-31")), ("2024-02-30", None), ("", None)]),
    "to_money": (values.to_money, [("12.345", Decimal("12.35")), ("-1", Decimal("-1.00")), ("x", None), ("123456789.5", None)]),
    "to_number": (values.to_number, [("1e3", 1000.0), (" -.5", -0.5), ("1d", None), ("5\r", None), ("NaN", None)]),
    "to_moment": (
        lambda c: values.to_moment(c).isNotNull(),
        [("2024-01-31", True), ("2024-01-31 10:00:00", True), ("1/31/2024", True), ("2024", False), ("12:00", False)],
    ),
}


@pytest.mark.parametrize("name", CASES)
def test_rule(rows, name):
    rule, cases = CASES[name]
    assert apply(rows, rule, [c[0] for c in cases]) == [c[1] for c in cases]


def test_merge_gender(rows):
    df = rows([(1, None, "Male"), (2, "Male", "Female"), (3, "Other", "Male"), (4, "Male", None), (5, None, None)],
              "i int, a string, b string")
    got = df.orderBy("i").select(codes.merge_gender(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in got] == ["Male", None, None, "Male", None]


def test_joined_reads_null_as_blank(rows):
    df = rows([("a", None)], "a string, b string")
    assert df.select(text.joined(F.col("a"), F.lit("-"), F.col("b"))).first()[0] == "a-"


def test_elapsed_counts_clock_ticks(rows):
    t = datetime.datetime.fromisoformat
    df = rows([(t("2024-01-01 00:00:00.000900"), t("2024-01-01 00:00:01.000100"))], "a timestamp, b timestamp")
    assert df.select(values.elapsed_ms(F.col("a"), F.col("b"))).first()[0] == 1000


def test_flag_rate_is_a_fraction(rows):
    df = rows([("Y",), ("N",), ("N",)], "f string")
    assert df.select(values.flag_rate(F.col("f"))).first()[0] == 0.33
    assert df.limit(0).select(values.flag_rate(F.col("f"))).first()[0] is None
