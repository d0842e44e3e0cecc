"""Ranked lexical search in which documents with the same bag of query terms are scored once."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from oreflow.llm.common import as_batch, column, slices
from oreflow.session import written

TOP = 20
# Stands for all terms of a text together; no term is empty.
ALL_TERMS = ""

# A term is a run of ASCII letters and digits and of characters beyond ASCII; on UTF-8 bytes those are 0x80 and up.
_TERM_BYTES = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))

_COUNTS = pa.schema(
    [("row", pa.int64()), ("doc_id", pa.int64()), ("terms", pa.list_(pa.string())), ("times", pa.list_(pa.int64()))]
)
_COUNTS_DDL = "row bigint, doc_id bigint, terms array<string>, times array<bigint>"


def terms_of(text: bytes) -> list[bytes]:
    """All terms in order, A-Z lowered."""
    return text.lower().translate(_TERM_BYTES).split()


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in slices(batch, "text"):
            terms, times = [], []
            for text in texts:
                own = terms_of(text)
                counts = Counter(own)
                terms.append([ALL_TERMS, *(t.decode() for t in counts)] if own else [])
                times.append([len(own), *counts.values()] if own else [])
            yield as_batch(
                _COUNTS, {"row": part.column(0), "doc_id": part.column(1), "terms": terms, "times": times}
            )


def term_counts(rows: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(row, doc_id, term, times) per distinct term of each text, and the number of all its terms under ALL_TERMS.

    ``row`` tells rows of one id apart, within one job.  A text without terms has no rows.
    """
    keyed = rows.select(
        F.monotonically_increasing_id().alias("row"),
        column(id_column).cast("long").alias("doc_id"),
        column(text_column).cast("string").alias("text"),
    )
    counted = keyed.mapInArrow(_term_counts, _COUNTS_DDL)
    return counted.select("row", "doc_id", F.inline(F.arrays_zip("terms", "times")).alias("term", "times"))


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    top: int = TOP,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """Each item's ``top`` highest-scoring documents: item_id, rank from 1, doc_id, score.

    With N documents that have terms, L terms in all, and n, tf and df as usual, a term weighs
    w = floor(1000 ln((2N + 2) / (2df + 1))), a document has m = 75 + 25nN div L, and it scores
    w * (10^9 tf div (1000 tf + 12m)) for every term of the item, repeats included.  Only scores above 0 count;
    equal ones go by ascending doc_id, null last.  A null or empty text has no terms: as a document it is in no
    statistic, as an item it finds nothing.  Documents that repeat an id are ranked one by one; items that
    repeat an id are one item with the terms of all; a null item id is an id.  An empty table on either side
    gives an empty result; other columns are not read.

    Documents are cut down to the terms that items have.  Those with the same m and the same counts form a
    class: rows meet by a hash of both, and whole bags are compared.  A class is scored once, however many
    documents it has, by joins on terms; its score and its least id place it among the others.  No more than
    ``top`` classes, and of each the ``top`` lowest ids, can be among an item's best, and a task keeps no
    more of either before they are shuffled.  Statistics come from all documents, and Spark broadcasts the
    items' terms only if they are small.
    """
    given = term_counts(items, item_column, item_text_column).where(F.col("term") != ALL_TERMS)
    asked = written(given.groupBy(F.col("doc_id").alias("item_id"), "term").agg(F.sum("times").alias("times")))
    # Numbers instead of terms from here on; 0 for all terms.
    names = asked.select("term").distinct().unionByName(docs.sparkSession.range(1).select(F.lit(ALL_TERMS).alias("term")))
    numbered = written(
        names.select("term", F.when(F.col("term") == ALL_TERMS, 0).otherwise(F.monotonically_increasing_id() + 1).alias("number"))
    )

    counts = term_counts(docs, id_column, text_column).join(numbered, "term")
    entry = F.struct("number", "times")
    bags = counts.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.array_sort(F.collect_list(entry)).alias("bag"))
    bags = written(
        bags.select("doc_id", F.col("bag")[0]["times"].alias("n"), F.filter("bag", lambda e: e["number"] > 0).alias("bag"))
    )
    total = bags.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()

    length = F.expr(f"75 + ((25 * n * {total.docs}L) div {total.terms or 1}L)")
    members = bags.where(F.size("bag") > 0).select("doc_id", "bag", length.alias("m"))
    members = members.withColumn("hash", F.xxhash64("m", "bag"))
    key = ["hash", "m", "bag"]
    classes = members.groupBy(*key).agg(
        F.count(F.lit(1)).alias("members"), F.min("doc_id").alias("least")
    )
    classes = written(classes.withColumn("class", F.monotonically_increasing_id()))

    entries = classes.select("class", "m", "members", F.inline("bag").alias("number", "tf"))
    weight = F.floor(1000 * F.log((F.lit(2.0 * total.docs) + 2) / (2 * F.sum("members") + 1)))
    weights = entries.groupBy("number").agg(weight.cast("long").alias("weight"))
    asked = asked.join(numbered, "term").join(weights, "number")
    asked = written(asked.where("weight > 0").select("number", "item_id", (F.col("weight") * F.col("times")).alias("weight")))

    # Rows of a class stay in one partition from here to its scores, so these are summed without a shuffle of their own.
    spread = classes.repartition("class").select("class", "least", "m", F.inline("bag").alias("number", "tf"))
    part = F.expr("weight * ((1000000000L * tf) div (1000L * tf + 12L * m))")
    scored = spread.join(asked, "number").groupBy("class", "item_id").agg(
        F.sum(part).alias("score"), F.first("least").alias("least")
    )
    by_class = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("least"), "class")
    best = written(
        scored.where("score > 0").withColumn("place", F.row_number().over(by_class)).where(F.col("place") <= top)
        .select("item_id", "class", "score")
    )

    wanted = classes.join(best.select("class").distinct(), "class").select("class", *key)
    by_id = Window.partitionBy("class").orderBy(F.asc_nulls_last("doc_id"))
    lowest = members.join(wanted, key).select("class", "doc_id")
    lowest = written(lowest.withColumn("place", F.row_number().over(by_id)).where(F.col("place") <= top))
    by_score = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = best.join(lowest, "class").withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= top)
    return ranked.select("item_id", "rank", "doc_id", "score")
