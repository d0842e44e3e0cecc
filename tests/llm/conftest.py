import pytest

from oreflow.llm.common import ready


@pytest.fixture(scope="session")
def spark(spark):
    return ready(spark)


# Nulls in any column, empty and blank texts, a long text, repeated rows and ids, a clashing extra column.
LONG = "word salad of many kinds\nand lines " * 4000


@pytest.fixture(scope="session")
def odd_docs(spark):
    rows = [
        (1, "one two three four five six seven eight", "en", "s0"),
        (2, "one two three four five six seven eight", "en", "s0"),
        (2, "one two three four five six seven eight", "en", "s0"),
        (3, None, None, None),
        (4, "", "en", "s1"),
        (None, "one  two three four five six seven eight", None, "s1"),
        (None, None, None, None),
        (5, LONG, "de", "s0"),
        (6, " \n\t ", "de", "s2"),
        (7, "Ünïcödé <|endoftext|> don't “quote”, é ABC,def 12x y \x01z", "fr", "s2"),
    ]
    return spark.createDataFrame(
        [(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string, key int"
    )


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
