"""One registered query per operator, over whole tables, with SQL where SQL can say the same."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.llm import minhash
from oreflow.llm.bag_search import rank_documents
from oreflow.llm.bitplanes import read_index, write_tokens
from oreflow.llm.bm25_packing import pack, pieces
from oreflow.llm.chat_format import format_conversations, read_back
from oreflow.llm.common import read, ready
from oreflow.llm.exact_dedup import exact_duplicates
from oreflow.llm.feast import by_component, whiten
from oreflow.llm.line_chunks import dedup_line_chunks
from oreflow.llm.mixing import mix, words_of
from oreflow.llm.pu_quality import classify
from oreflow.llm.shuffle_shards import hypergeometric_shuffle
from oreflow.llm.simhash import near_duplicates
from oreflow.llm.va_search import top_products
from oreflow.session import scratch_folder, written

TOKENIZER = "word_bpe_49k.json"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(ready(spark), sf_dir)

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return build

    return register


@query("op3_hypergeometric_shuffle")
def _op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = read(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(F.encode(text, "utf-8")).alias("text_crc32"),
    )
    return hypergeometric_shuffle(rows).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query(
    "op6_relational_chat",
    r"""
    WITH given AS (
        SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
        UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
    ), placed AS (
        SELECT *, row_number() OVER w AS place, lag(role) OVER w AS before, lead(role) OVER w AS after,
               count(*) OVER (PARTITION BY conv_id) AS n,
               length(replace(replace(replace(replace(text, '\', '\b'), '[', '\l'), ']', '\r'), '<', '\a')) AS chars
        FROM given WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text)
    )
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(coalesce(role, '') || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
           sum(chars + CASE WHEN place > 1 AND before IS NOT DISTINCT FROM role THEN 3 ELSE 2 + coalesce(length(role), 0) END
                     + CASE WHEN place < n AND after IS NOT DISTINCT FROM role THEN 0 ELSE 4 END)::BIGINT AS formatted_chars
    FROM placed GROUP BY conv_id
    """,
)
def _op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    adverse = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    back = read_back(format_conversations(turns.unionByName(adverse)))
    each = F.transform(
        "turns", lambda t: F.concat(F.coalesce(t["role"], F.lit("")), F.lit("\n"), t["text"], F.lit("\n"))
    )
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(each, ""), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@query(
    "op8_polynomial_fingerprints",
    r"""
    WITH plain AS (
        SELECT doc_id, length(coalesce(text, '')) AS points,
               regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body FROM documents
    ), ranked AS (
        SELECT doc_id, body, row_number() OVER w AS place, first_value(doc_id) OVER w AS keep_id,
               count(*) OVER (PARTITION BY body) AS group_size
        FROM plain WINDOW w AS (PARTITION BY body ORDER BY points DESC, doc_id NULLS LAST)
    )
    SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(body) AS text_sha256 FROM ranked
    """,
)
def _op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(read(spark, sf_dir, "documents"))


@query("op1_bit_planes")
def _op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_folder(spark)}/tokens-{uuid.uuid4().hex}"
    write_tokens(read(spark, sf_dir, "documents"), path, public_tokenizers.path(TOKENIZER))
    return read_index(spark, path)


@query("op7_covering_simhash")
def _op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))


@query(
    "op9_va_file_topk",
    """
    WITH whole AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
        WHERE vec_id IS NOT NULL AND len(embedding) > 0
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scored AS (
        SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
        FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)
    )
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
    FROM scored QUALIFY rank <= 5
    """,
)
def _op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_products(read(spark, sf_dir, "embeddings"))


@query("op2_pu_quality")
def _op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op4_line_chunks")
def _op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_line_chunks(docs, removed="removed").select(
        "doc_id",
        F.col("removed").isNotNull().alias("changed"),
        F.coalesce(F.aggregate("removed", F.lit(0), lambda n, r: n + r["size"]), F.lit(0)).alias("lines_removed"),
        F.octet_length("text").alias("bytes_left"),
        F.sha2("text", 256).alias("text_sha256"),
    )


@query("op5_bm25_packing")
def _op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces(pack(read(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER)))


# Target weights of the registered mixture; names carry "=", sources share by a power of their tokens.
DOMAIN_WEIGHTS = {"=d0": 4, "=d1": 3, "=d2": 2}
LANG_WEIGHTS = {"=en": 4, "=de": 2}
SOURCE_POWER = 0.7


def weighted(name, weights: dict[str, int]):
    out = F.lit(1)
    for key, weight in weights.items():
        out = F.when(name == key, weight).otherwise(out)
    return out


def target_weights(names, tokens):
    return [weighted(names[0], DOMAIN_WEIGHTS), weighted(names[1], LANG_WEIGHTS), F.pow(tokens.cast("double"), SOURCE_POWER)]


def domain_of(source):
    return F.concat(F.lit("d"), F.ascii(F.right(source, F.lit(1))) % 4)


def _level(depth: int) -> str:
    """One level of the budget tree in SQL, over ``leaves`` and the level above."""
    names = ["domain", "lang", "source"][:depth]
    path, parent = ", ".join(names), ", ".join(names[:-1])
    given = f"branch_{depth} AS (SELECT {path}, sum(tokens) AS tokens, 4.0::DOUBLE * sum(tokens) AS cap FROM leaves GROUP BY {path})"
    weight = [
        "CASE domain WHEN 'd0' THEN 4 WHEN 'd1' THEN 3 WHEN 'd2' THEN 2 ELSE 1 END",
        "CASE lang WHEN 'en' THEN 4 WHEN 'de' THEN 2 ELSE 1 END",
        "pow(tokens::DOUBLE, 0.7)",
    ][depth - 1]
    budget = (
        "branch_1, (SELECT 0.5::DOUBLE * sum(tokens) AS budget FROM leaves)"
        if depth == 1
        else f"branch_{depth} JOIN (SELECT {parent}, given AS budget FROM given_{depth - 1}) USING ({parent})"
    )
    by = f"PARTITION BY {parent} " if parent else ""
    return f"""{given},
    weighed_{depth} AS (SELECT *, {weight}::DOUBLE AS weight FROM {budget}),
    leveled_{depth} AS (
        SELECT *, (budget - coalesce(sum(cap) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                  / sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS here
        FROM weighed_{depth} WINDOW w AS ({by}ORDER BY cap / weight, {names[-1]})
    ),
    given_{depth} AS (
        SELECT {path}, tokens, least(cap, coalesce(weight * first_value(CASE WHEN cap / weight >= here THEN here END IGNORE NULLS)
                   OVER ({by}ORDER BY cap / weight, {names[-1]} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), cap)) AS given
        FROM leveled_{depth}
    )"""


@query(
    "op10_hierarchical_mix",
    rf"""
    WITH docs AS (
        SELECT doc_id, lang, source, len(regexp_split_to_array(trim(coalesce(text, ''), E' 

	'), '[ 

	]+')) AS tokens FROM documents
    ), domains AS (
        SELECT DISTINCT source, 'd' || (ascii(right(source, 1)) % 4) AS domain FROM docs
    ), placed AS (SELECT * FROM docs JOIN domains USING (source)),
    leaves AS (SELECT domain, lang, source, sum(tokens) AS tokens FROM placed GROUP BY ALL),
    {_level(1)}, {_level(2)}, {_level(3)},
    quotas AS (
        SELECT domain, lang, source, round(given)::BIGINT // tokens::BIGINT AS whole, round(given)::BIGINT % tokens::BIGINT AS rest FROM given_3
    )
    SELECT doc_id, domain, lang, source, tokens::BIGINT AS tokens,
           whole + CASE WHEN sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY md5('7:' || whole || ':' || doc_id)) - tokens < rest
                        THEN 1 ELSE 0 END AS copies
    FROM placed JOIN quotas USING (domain, lang, source)
    """,
)
def _op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "documents").select(
        "doc_id", domain_of(F.col("source")).alias("domain"), "lang", "source", words_of(F.col("text")).alias("tokens")
    )
    levels = [F.col("domain"), F.col("lang"), F.col("source")]
    return mix(written(rows), levels, target_weights, F.col("tokens"), share=0.5).select(
        "doc_id", "domain", "lang", "source", "tokens", "copies"
    )


@query(
    "op11_bag_dedup_search",
    r"""
    WITH texts AS (
        SELECT 0 AS side, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark
    ), cut AS (
        SELECT side, id, row_number() OVER () AS k, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM texts
    ), total AS (
        SELECT count(*) AS docs, sum(len(terms))::BIGINT AS terms FROM cut WHERE side = 0 AND len(terms) > 0
    ), counted AS (
        SELECT side, id, k, n, term, count(*) AS tf
        FROM (SELECT side, id, k, len(terms) AS n, unnest(terms) AS term FROM cut) GROUP BY ALL
    ), weights AS (
        SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
        FROM (SELECT term, count(*) AS df FROM counted WHERE side = 0 GROUP BY term), total
    ), scored AS (
        SELECT i.id AS item_id, d.id AS doc_id, d.k,
               sum(i.tf * w * ((1000000000 * d.tf) // (1000 * d.tf + 12 * (75 + ((25 * d.n * docs) // total.terms)))))::BIGINT AS score
        FROM counted i JOIN counted d ON i.side = 1 AND d.side = 0 AND i.term = d.term JOIN weights ON weights.term = i.term, total
        GROUP BY i.id, d.id, d.k
    )
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
    FROM scored WHERE score > 0 QUALIFY rank <= 20
    """,
)
def _op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query("op12_feast_whitening")
def _op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_component(whiten(read(spark, sf_dir, "embeddings")))


@query(
    "op13_bbit_minhash",
    r"""
    WITH RECURSIVE cut AS (
        SELECT doc_id, list_filter(string_split_regex(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
            lambda w: w <> '') AS w FROM documents
    ), sets AS (
        SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
            ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: concat_ws(' ', w[i], w[i + 1], w[i + 2], w[i + 3])))
            END AS s FROM cut
    ), items AS MATERIALIZED (SELECT doc_id, len(s) AS n, hash(t) AS t FROM (SELECT doc_id, s, unnest(s) AS t FROM sets)),
    links AS MATERIALIZED (
        SELECT a.doc_id AS a, b.doc_id AS b FROM items a JOIN items b ON a.t = b.t AND a.doc_id <> b.doc_id
        GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
    ), reach(doc_id, other) AS (
        SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a
    )
    SELECT doc_id, len(s)::BIGINT AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
    FROM sets JOIN reach USING (doc_id) GROUP BY doc_id, s
    """,
)
def _op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents"))
