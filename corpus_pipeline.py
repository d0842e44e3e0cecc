"""From raw documents to packed training sequences, in five stages.

Each stage is a function of (spark, docs, sf_dir); its result is written to the shared folder and read again as
the next one's docs.  ``sf_dir`` is only used for the labels that the quality classifier learns from.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.llm.bm25_packing import pack, pieces
from oreflow.llm.common import read, ready
from oreflow.llm.line_chunks import dedup_line_chunks
from oreflow.llm.mixing import mix, words_of
from oreflow.llm.pu_quality import keep_good
from oreflow.llm.queries import TOKENIZER, domain_of
from oreflow.llm.simhash import keep_first
from oreflow.session import scratch_folder

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# Branches are weighted by this power of their tokens: large ones give way to small ones, none vanishes.
EVENNESS = 0.9


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return keep_good(docs.select(*COLUMNS), read(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of several lines stay in the first document that has them; every document stays."""
    return dedup_line_chunks(docs).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document stays of each group that links of at most three differing fingerprint bits connect: the smallest id."""
    return keep_first(docs).select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many tokens as came in, dealt out anew by weight; a document taken twice is there twice."""

    def weights(names, tokens):
        return [F.pow(tokens.cast("double"), EVENNESS) for _ in names]

    levels = [domain_of(F.col("source")), F.col("lang"), F.col("source")]
    mixed = mix(docs, levels, weights, words_of(F.col("text")), share=1.0)
    times = F.sequence(F.lit(1).cast("long"), F.col("copies"))
    return mixed.where("copies > 0").withColumn("copy", F.explode(times)).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 4096 tokens, beside lexical neighbours."""
    return pieces(pack(docs, public_tokenizers.path(TOKENIZER)))


def _ready(stage):
    return lambda spark, docs, sf_dir: stage(ready(spark), docs, sf_dir)


STAGES = [
    ("quality classifier", _ready(quality)),
    ("line dedup", _ready(line_dedup)),
    ("simhash near-dedup", _ready(near_dedup)),
    ("source mixing", _ready(mixing)),
    ("packing", _ready(packing)),
]

# The classifier, seeded hashes and the tokenizer have no counterpart in SQL; tests hold the stages against
# plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    folder = f"{scratch_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            path = f"{folder}/{number}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
