"""Code lists and the rules that read them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label -> accepted codes, in upper case.
MARITAL_STATUS = {"Married": ["M", "MARRIED"], "Single": ["S", "SINGLE"]}
GENDER = {"Male": ["M", "MALE"], "Female": ["F", "FEMALE"]}
PRODUCT_LINE = {"Mountain": ["M"], "Road": ["R"], "Touring": ["T"], "Miscellaneous": ["S"]}
COUNTRY = {
    "Australia": ["AUSTRALIA", "AU"],
    "Canada": ["CANADA", "CA"],
    "France": ["FRANCE", "FR"],
    "Germany": ["GERMANY", "DE"],
    "United Kingdom": ["UNITED KINGDOM", "GB", "UK"],
    "United States": ["UNITED STATES", "USA", "US"],
}
YES_NO = {"Yes": ["Y", "YES"], "No": ["N", "NO"]}
CATEGORY_CORRECTION = {"CO_PD": ["CO_PE"]}

OTHER = "Other"


def decode(c: Column, labels: dict[str, list[str]], unknown: Column) -> Column:
    """Map codes to labels; NULL never matches and takes ``unknown`` like any other miss.

    A lookup in a literal map evaluates ``c`` once, where a CASE would do so per branch.
    """
    by_code = F.create_map(*[F.lit(x) for label, codes in labels.items() for code in codes for x in (code, label)])
    return F.coalesce(F.try_element_at(by_code, c), unknown)


def label_or_other(c: Column, labels: dict[str, list[str]]) -> Column:
    """Case-insensitive label; unknown codes are 'Other', NULL stays NULL."""
    return decode(F.upper(c), labels, F.when(c.isNotNull(), F.lit(OTHER)))


def label_or_null(c: Column, labels: dict[str, list[str]]) -> Column:
    return decode(F.upper(c), labels, F.lit(None).cast("string"))


def category_of(product_key: Column) -> Column:
    """First five characters with ``_`` for ``-``, corrected to the catalogue's spelling."""
    category = F.replace(F.left(product_key, F.lit(5)), F.lit("-"), F.lit("_"))
    return decode(category, CATEGORY_CORRECTION, category)


def merge_gender(main: Column, second: Column) -> Column:
    """Main source, filled from the second; NULL where the two disagree."""
    return F.when(main.isNull(), second).when(main != second, F.lit(None)).otherwise(main)
