"""The registered queries: every operator run over whole provided tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.functions import codes, text, values
from oreflow.operators import changes, checks, dates, frequent, profile, reconcile, runlog, sketches
from oreflow.operators.fill import fill_from_siblings
from oreflow.operators.survivors import survivors
from oreflow.operators.versions import chain_end_dates, version_join
from oreflow.plans import gold, silver
from oreflow.plans.incremental import Incremental
from oreflow.plans.refresh import Refresh, refresh_all
from oreflow.schemas import BRONZE, GOLD, SILVER, Reference
from oreflow.session import scratch_folder, tune, written, written_all
from oreflow.sources import delimited
from oreflow.sources.tables import Warehouse, file_ranges, reload
from oreflow.workload import oracles
from oreflow.workload.oracles import over
from oreflow.workload.raw_sources import (
    CHANGES, NEXT, ORPHANED, PART_CATEGORIES, RAW, RUN_EVENTS, SOUND, TOO_LARGE, changed, derive, given, raw,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str) -> Callable[[Query], Query]:
    """Register a query with the SQL that checks it."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(tune(spark), sf_dir)

        QUERIES[name] = run
        ORACLES[name] = sql
        return build

    return register


class Silver(Mapping):
    """Silver tables by name, planned when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getitem__(self, name: str) -> DataFrame:
        return silver.TABLES[name](raw(self.spark, self.sf_dir, name))

    def __iter__(self):
        return iter(silver.TABLES)

    def __len__(self):
        return len(silver.TABLES)


def written_silver(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return written_all(dict(Silver(spark, sf_dir).items()))


def products_and_facts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Dimension and order lines as written tables, as the fact load finds them, and the facts on them."""
    tables = Silver(spark, sf_dir)
    ready = written_all(
        {"dim_product": gold.dim_product(tables), "crm_sales_details": tables["crm_sales_details"]}
    )
    return ready["dim_product"], gold.fact_sales(ready, ready["dim_product"])


def written_gold(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    products, facts = products_and_facts(spark, sf_dir)
    rest = {"dim_customer": gold.dim_customer(Silver(spark, sf_dir)), "fact_sales": facts}
    return {"dim_product": products, **written_all(rest)}


# -- layers --------------------------------------------------------------------------------------

for _table, _name in {
    "crm_cust_info": "silver_cust_info",
    "crm_prd_info": "silver_prd_info",
    "crm_sales_details": "silver_sales_details",
    "erp_cust_az12": "silver_erp_cust",
    "erp_loc_a101": "silver_erp_loc",
    "erp_px_cat_g1v2": "silver_px_cat",
}.items():
    query(_name, over(_table, f"SELECT * FROM {_table}"))(
        lambda spark, sf_dir, table=_table: Silver(spark, sf_dir)[table]
    )


@query("silver_part_categories", over("raw_part_categories", oracles.categories("raw_part_categories")))
def _(spark, sf_dir):
    return silver.erp_categories(derive(spark, sf_dir, PART_CATEGORIES))


@query("dim_customer", over("dim_customer", "SELECT * FROM dim_customer"))
def _(spark, sf_dir):
    return gold.dim_customer(Silver(spark, sf_dir))


@query("dim_product", over("dim_product", "SELECT * FROM dim_product"))
def _(spark, sf_dir):
    return gold.dim_product(Silver(spark, sf_dir))


@query("fact_sales", over("fact_sales", "SELECT * FROM fact_sales"))
def fact_sales(spark, sf_dir):
    return products_and_facts(spark, sf_dir)[1]


@query(
    "flag_rates",
    over(
        "fact_sales",
        "SELECT "
        + ", ".join(f"round(avg(CASE WHEN {f} = 'Y' THEN 1.0 ELSE 0.0 END), 2) AS {f}" for f in gold.FLAGS)
        + " FROM fact_sales",
    ),
)
def _(spark, sf_dir):
    return checks.flag_rates(products_and_facts(spark, sf_dir)[1], gold.FLAGS)


# -- column rules over whole tables --------------------------------------------------------------


@query(
    "rules_codes",
    f"""SELECT c_custkey, {oracles.marital('status')} AS marital_status, {oracles.gender('gender')} AS gender,
       {oracles.line('line')} AS product_line, {oracles.country('country')} AS country,
       {oracles.yes_no('flag')} AS yes_no,
       CASE WHEN {oracles.gender('gender')} IS NULL THEN {oracles.gender('gender2')}
            WHEN {oracles.gender('gender')} <> {oracles.gender('gender2')} THEN NULL
            ELSE {oracles.gender('gender')} END AS merged_gender
FROM (SELECT c_custkey, left(c_mktsegment, 1) || ' ' AS status,
             CASE c_custkey % 4 WHEN 0 THEN 'F' WHEN 1 THEN ' male' WHEN 2 THEN '' ELSE lower(left(c_mktsegment, 1)) END
               || chr(13) AS gender,
             CASE c_custkey % 3 WHEN 0 THEN 'm' WHEN 1 THEN 'FEMALE ' ELSE '  ' END AS gender2,
             substring(c_mktsegment, 2, 1) AS line, n_name || chr(13) AS country, left(n_name, 1) AS flag
      FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)""",
)
def _(spark, sf_dir):
    key, segment = F.col("c_custkey"), F.col("c_mktsegment")
    first = F.left(segment, F.lit(1))
    joined = given(spark, sf_dir, "customer").join(
        given(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )
    texts = joined.select(
        key,
        F.concat(first, F.lit(" ")).alias("status"),
        F.concat(
            F.when(key % 4 == 0, "F").when(key % 4 == 1, " male").when(key % 4 == 2, "").otherwise(F.lower(first)),
            F.lit("\r"),
        ).alias("gender"),
        F.when(key % 3 == 0, "m").when(key % 3 == 1, "FEMALE ").otherwise("  ").alias("gender2"),
        F.substring(segment, 2, 1).alias("line"),
        F.concat("n_name", F.lit("\r")).alias("country"),
        F.left(F.col("n_name"), F.lit(1)).alias("flag"),
    )

    def label(column, labels):
        return codes.label_or_other(text.clean_last_field(F.col(column)), labels)

    return texts.select(
        "c_custkey",
        label("status", codes.MARITAL_STATUS).alias("marital_status"),
        label("gender", codes.GENDER).alias("gender"),
        label("line", codes.PRODUCT_LINE).alias("product_line"),
        label("country", codes.COUNTRY).alias("country"),
        codes.label_or_null(text.clean_last_field(F.col("flag")), codes.YES_NO).alias("yes_no"),
        codes.merge_gender(label("gender", codes.GENDER), label("gender2", codes.GENDER)).alias("merged_gender"),
    )


@query(
    "rules_text",
    f"""SELECT p_partkey, {oracles.clean('padded')} AS cleaned, {oracles.clean_last('last')} AS cleaned_last,
       {oracles.sentence('name')} AS sentence, left(name, 7) AS clipped, substring(name, 7) AS tail,
       CASE WHEN instr(name, 'a') > 0 THEN substring(name, instr(name, 'a')) END AS from_first,
       CASE WHEN name LIKE 're%' THEN substring(name, 3) ELSE name END AS without_prefix,
       replace(brand, '#', '') AS replaced, upper(name) AS uppered,
       coalesce(name, '') || '/' || coalesce(brand, '') AS joined, length(name) AS len,
       {oracles.category("'CO-PE-' || name")} AS fixed_category, {oracles.category('name')} AS category
FROM (SELECT p_partkey, p_name AS name, CASE WHEN p_partkey % 7 <> 0 THEN p_brand END AS brand,
             CASE WHEN p_size % 5 = 0 THEN '   ' ELSE '  ' || p_name || ' ' END AS padded,
             CASE WHEN p_size % 3 = 0 THEN ' ' WHEN p_size % 3 = 1 THEN p_type ELSE p_type || ' ' END || chr(13) AS last
      FROM part)""",
)
def _(spark, sf_dir):
    size = F.col("p_size")
    parts = given(spark, sf_dir, "part").select(
        "p_partkey",
        F.col("p_name").alias("name"),
        F.when(F.col("p_partkey") % 7 != 0, F.col("p_brand")).alias("brand"),
        F.when(size % 5 == 0, "   ").otherwise(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("padded"),
        F.concat(
            F.when(size % 3 == 0, " ").when(size % 3 == 1, F.col("p_type")).otherwise(F.concat("p_type", F.lit(" "))),
            F.lit("\r"),
        ).alias("last"),
    )
    name, brand = F.col("name"), F.col("brand")
    return parts.select(
        "p_partkey",
        text.clean(F.col("padded")).alias("cleaned"),
        text.clean_last_field(F.col("last")).alias("cleaned_last"),
        text.sentence_case(name).alias("sentence"),
        text.clip(name, 7).alias("clipped"),
        text.tail(name, 7).alias("tail"),
        text.from_first(name, "a").alias("from_first"),
        text.without_prefix(name, "re").alias("without_prefix"),
        F.replace(brand, F.lit("#"), F.lit("")).alias("replaced"),
        F.upper(name).alias("uppered"),
        text.joined(name, F.lit("/"), brand).alias("joined"),
        F.length(name).cast("long").alias("len"),
        codes.category_of(F.concat(F.lit("CO-PE-"), name)).alias("fixed_category"),
        codes.category_of(name).alias("category"),
    )


@query(
    "rules_values",
    """SELECT o_orderkey, try_cast(CASE WHEN o_orderkey % 5 = 0 THEN 'x' ELSE '' END || o_orderkey AS int) AS as_int,
       CASE WHEN length(day) = 8 THEN try_cast(left(day, 4) || '-' || substring(day, 5, 2) || '-' || substring(day, 7, 2) AS date) END
         AS compact_date,
       try_cast(CASE o_orderkey % 3 WHEN 0 THEN '2024-02-30' ELSE cast(cast(o_orderdate AS date) AS string) END AS date) AS as_date,
       try_cast(money AS decimal(10,2)) AS as_money, abs(try_cast('-' || money AS decimal(10,2))) AS abs_money,
       cast(o_orderdate AS date) - 1 AS day_before,
       CASE WHEN cast(o_orderdate AS date) >= date '1998-01-01' THEN date '9999-12-31' ELSE cast(o_orderdate AS date) END AS open_end,
       CASE WHEN o_orderpriority < o_orderstatus THEN 'Y' ELSE 'N' END AS flagged,
       CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END + CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END AS nulls,
       CASE WHEN o_orderpriority NOT LIKE '3-%' THEN o_orderkey % 1000 * 86400000 + 250 END AS elapsed
FROM (SELECT *, CASE o_orderkey % 4 WHEN 0 THEN '0' WHEN 1 THEN '20241340'
                     ELSE replace(cast(cast(o_orderdate AS date) AS string), '-', '') END AS day,
             cast(o_orderkey AS string) || '.' || CASE o_orderkey % 3 WHEN 0 THEN '125' WHEN 1 THEN '5' ELSE '994' END AS money
      FROM orders)""",
)
def _(spark, sf_dir):
    key, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    digits = F.replace(day.cast("string"), F.lit("-"), F.lit(""))
    money = F.concat(
        key.cast("string"), F.lit("."), F.when(key % 3 == 0, "125").when(key % 3 == 1, "5").otherwise("994")
    )
    began = F.col("o_orderdate").cast("timestamp")
    ended = F.when(
        ~F.col("o_orderpriority").startswith("3-"),
        F.timestamp_millis(F.unix_millis(began) + key % 1000 * 86400000 + 250),
    )
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    priority = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority"))
    return given(spark, sf_dir, "orders").select(
        "o_orderkey",
        values.to_int(text.joined(F.when(key % 5 == 0, "x"), key)).alias("as_int"),
        values.compact_date(F.when(key % 4 == 0, "0").when(key % 4 == 1, "20241340").otherwise(digits)).alias(
            "compact_date"
        ),
        values.to_date(F.when(key % 3 == 0, "2024-02-30").otherwise(day.cast("string"))).alias("as_date"),
        values.to_money(money).alias("as_money"),
        F.abs(values.to_money(F.concat(F.lit("-"), money))).alias("abs_money"),
        F.date_sub(day, 1).alias("day_before"),
        values.or_open_end(F.when(day < "1998-01-01", day)).alias("open_end"),
        values.flag(F.col("o_orderpriority") < F.col("o_orderstatus")).alias("flagged"),
        values.null_count(status, priority).alias("nulls"),
        values.elapsed_ms(began, ended).alias("elapsed"),
    )


@query(
    "rules_money",
    """SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey, cast(sales2 AS decimal(21,2)) AS filled_sales,
       cast(price2 AS decimal(10,2)) AS filled_price,
       cast(CASE WHEN abs(sales2) <> price2 * qty THEN price2 * qty * (CASE WHEN sales2 < 0 THEN -1 ELSE 1 END)
                 ELSE sales2 END AS decimal(21,2)) AS reconciled,
       CASE WHEN sales2 IS NULL AND price2 IS NULL THEN 'Y' ELSE 'N' END AS incomplete
FROM (SELECT *, coalesce(sales, qty * price) AS sales2,
             -- half up on whole cents, free of floating point
             coalesce(price, CASE WHEN qty <> 0 THEN
                 cast((2 * cast(abs(sales) * 100 AS bigint) + qty) // (2 * qty) AS decimal(18,2)) / 100 END)::decimal(10,2) AS price2
      FROM (SELECT *, CASE l_linenumber WHEN 7 THEN 0 WHEN 6 THEN NULL ELSE cast(l_quantity AS int) END AS qty,
                   CASE WHEN l_suppkey % 5 = 0 THEN NULL WHEN l_suppkey % 5 = 1 THEN -cast(l_extendedprice AS decimal(10,2))
                        ELSE cast(l_extendedprice AS decimal(10,2)) END AS sales,
                   CASE WHEN l_partkey % 3 > 0 THEN cast(cast(floor(l_extendedprice / 50) AS decimal(10,2)) + l_extendedprice % 1 AS decimal(10,2)) END AS price
            FROM (SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey, l_quantity,
                         cast(l_extendedprice AS decimal(10,2)) AS l_extendedprice FROM lineitem)))""",
)
def _(spark, sf_dir):
    amount = F.col("l_extendedprice").cast(values.MONEY)
    lines = given(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_suppkey",
        F.when(F.col("l_linenumber") == 7, 0)
        .when(F.col("l_linenumber") != 6, F.col("l_quantity").cast("int")).alias("qty"),
        F.when(F.col("l_suppkey") % 5 == 1, -amount)
        .when(F.col("l_suppkey") % 5 > 1, amount).alias("sales"),
        F.when(F.col("l_partkey") % 3 > 0, (F.floor(amount / 50) + amount % 1).cast(values.MONEY)).alias("price"),
    )
    amounts = [F.col(c) for c in ("sales", "qty", "price")]
    filled = lines.withColumns(
        {"sales": values.fill_sales(*amounts).cast("decimal(21,2)"), "price": values.fill_price(*amounts)}
    )
    return filled.select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_suppkey",
        F.col("sales").alias("filled_sales"),
        F.col("price").alias("filled_price"),
        values.reconcile_sales(*amounts).cast("decimal(21,2)").alias("reconciled"),
        values.flag(F.col("sales").isNull() & F.col("price").isNull()).alias("incomplete"),
    )


# -- generic operators with other parameters -----------------------------------------------------

_ORDERS = """SELECT o_custkey, CASE WHEN o_orderkey % 13 <> 0 THEN o_orderkey END AS record,
       CASE WHEN o_orderkey % 11 <> 0 THEN o_orderdate END AS placed,
       CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status,
       CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS priority FROM {orders}"""


@query(
    "survivors_orders",
    f"WITH records AS ({_ORDERS.format(orders='orders')})"
    + oracles.survivors("records", "o_custkey", "record", "placed", ["status", "priority"],
                        "o_custkey, record, placed, status, priority"),
)
def _(spark, sf_dir):
    records = derive(spark, sf_dir, _ORDERS)
    return survivors(records, "o_custkey", "record", "placed", ["status", "priority"])


_HISTORY = """SELECT o_custkey AS owner, o_orderkey AS version, o_orderstatus AS status,
       cast(o_orderdate AS date) AS since,
       CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN date '1990-01-01' WHEN 2 THEN date '2030-01-01'
            ELSE cast(o_orderdate AS date) END AS until FROM {orders}"""


@query(
    "chain_orders",
    f"""SELECT owner, version, status, since,
       CASE WHEN until IS NULL OR since > until THEN lead(since - 1) OVER (PARTITION BY owner ORDER BY version) ELSE until END AS until
FROM ({_HISTORY.format(orders='orders')})""",
)
def _(spark, sf_dir):
    return chain_end_dates(derive(spark, sf_dir, _HISTORY), "owner", "version", "since", "until")


# Several rows share a version id, some of them without a start.
_COPIES = """SELECT o_custkey % 7 AS owner, o_orderkey DIV 4 AS version, o_orderkey AS record,
       CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE cast(o_orderdate AS date) END AS since,
       CASE WHEN o_orderkey % 5 = 0 THEN date '2030-01-01' ELSE NULL END AS until FROM {orders}"""


@query(
    "chain_copies",
    f"""WITH copies AS ({_COPIES.replace('DIV', '//').format(orders='orders')}),
following AS (
  SELECT owner, version, lead(min(since)) OVER (PARTITION BY owner ORDER BY version) AS next_start
  FROM copies GROUP BY owner, version
)
SELECT owner, version, record, since,
       CASE WHEN until IS NULL OR since > until THEN next_start - 1 ELSE until END AS until
FROM copies JOIN following USING (owner, version)""",
)
def _(spark, sf_dir):
    return chain_end_dates(derive(spark, sf_dir, _COPIES), "owner", "version", "since", "until", slice_bits=11)


_SIGNUPS = """SELECT user_id AS owner, event_id AS version, cast(ts AS date) AS since, cast(NULL AS date) AS until
FROM {events} WHERE event_type = 'signup'"""
_ACTIONS = """SELECT event_id, user_id, event_type, CASE WHEN event_id % 17 <> 0 THEN cast(ts AS date) END AS day
FROM {events} WHERE event_type <> 'signup'"""


@query(
    "version_join_events",
    f"""WITH versions AS (
  SELECT owner, version, since, lead(since - 1) OVER (PARTITION BY owner ORDER BY version) AS until
  FROM ({_SIGNUPS.format(events='events')}))
SELECT event_id, user_id, event_type, day, version FROM ({_ACTIONS.format(events='events')})
LEFT JOIN versions ON user_id = owner AND day BETWEEN since AND coalesce(until, date '9999-12-31')""",
)
def _(spark, sf_dir):
    versions = written(chain_end_dates(derive(spark, sf_dir, _SIGNUPS), "owner", "version", "since", "until"))
    actions = derive(spark, sf_dir, _ACTIONS)
    return version_join(actions, versions, "user_id", "day", "owner", "since", "until", ["version"])


_SHIPMENTS = """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
       CASE WHEN l_partkey % 3 <> 0 THEN cast(l_shipdate AS date) END AS shipped FROM {lineitem}"""


@query(
    "sibling_fill_lineitem",
    f"""SELECT *, coalesce(shipped, max(shipped) OVER (PARTITION BY l_orderkey)) AS shipped_or_lent
FROM ({_SHIPMENTS.format(lineitem='lineitem')})""",
)
def _(spark, sf_dir):
    return fill_from_siblings(derive(spark, sf_dir, _SHIPMENTS), "l_orderkey", "shipped", "shipped_or_lent")


# -- the same with hot groups: a few keys hold all rows; ids fall into many slices ------------------


@query(
    "survivors_hot_status",
    "WITH records AS (SELECT o_orderkey, o_orderstatus, nullif(o_orderpriority, '5-LOW') AS priority,"
    " cast(o_orderdate AS date) AS day FROM orders)"
    + oracles.survivors("records", "o_orderstatus", "o_orderkey", "day", ["priority"],
                        "o_orderkey, o_orderstatus, priority, day"),
)
def _(spark, sf_dir):
    records = given(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_orderstatus",
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"),
        F.col("o_orderdate").cast("date").alias("day"),
    )
    return survivors(records, "o_orderstatus", "o_orderkey", "day", ["priority"])


@query(
    "sibling_fill_hot_flag",
    f"""SELECT *, coalesce(shipped, max(shipped) OVER (PARTITION BY l_linenumber)) AS shipped_or_lent
FROM ({_SHIPMENTS.format(lineitem='lineitem')})""",
)
def _(spark, sf_dir):
    lines = derive(spark, sf_dir, _SHIPMENTS)
    return fill_from_siblings(lines, "l_linenumber", "shipped", "shipped_or_lent")


_BY_TYPE = """SELECT event_type, cast(event_id AS int) AS version, cast(ts AS date) AS since,
       cast(NULL AS date) AS until FROM {events}"""


@query(
    "chain_hot_type",
    f"""SELECT event_type, version, since, lead(since - 1) OVER (PARTITION BY event_type ORDER BY version) AS until
FROM ({_BY_TYPE.format(events='events')})""",
)
def _(spark, sf_dir):
    versions = derive(spark, sf_dir, _BY_TYPE)
    return chain_end_dates(versions, "event_type", "version", "since", "until", slice_bits=11)


_DAYS = """SELECT event_id, event_type, CASE WHEN event_id % 17 <> 0 THEN cast(ts AS date) END AS day FROM {events}"""


@query(
    "version_join_crowded",
    f"""WITH versions AS (
  SELECT event_type AS kind, version, since, lead(since - 1) OVER (PARTITION BY event_type ORDER BY version) AS until
  FROM ({_BY_TYPE.format(events='events')}))
SELECT event_id, event_type, day, version FROM ({_DAYS.format(events='events')})
LEFT JOIN versions ON event_type = kind AND day BETWEEN since AND coalesce(until, date '9999-12-31')""",
)
def _(spark, sf_dir):
    versions = written(chain_end_dates(derive(spark, sf_dir, _BY_TYPE), "event_type", "version", "since", "until"))
    return version_join(
        derive(spark, sf_dir, _DAYS), versions.withColumnRenamed("event_type", "kind"), "event_type", "day",
        "kind", "since", "until", ["version"],
    )


_OVERLAPPING = """SELECT user_id AS owner, event_id AS version, cast(ts AS date) AS since,
       CASE WHEN event_id % 5 > 0 THEN date_add(cast(ts AS date), cast(event_id % 40 AS int)) END AS until FROM {events}"""


@query(
    "version_join_overlapping",
    f"""SELECT event_id, user_id, event_type, day, version FROM ({_ACTIONS.format(events='events')})
LEFT JOIN ({_OVERLAPPING.replace('date_add(cast(ts AS date), cast(event_id % 40 AS int))', 'cast(ts AS date) + cast(event_id % 40 AS int)').format(events='events')})
ON user_id = owner AND day BETWEEN since AND coalesce(until, date '9999-12-31')""",
)
def _(spark, sf_dir):
    versions = derive(spark, sf_dir, _OVERLAPPING)
    return version_join(derive(spark, sf_dir, _ACTIONS), versions, "user_id", "day", "owner", "since", "until", ["version"])


# -- checks --------------------------------------------------------------------------------------


@query(
    "null_key_check",
    over("raw_crm_cust_info", " UNION ALL ".join(
        f"SELECT 'null_key' AS \"check\", 'crm_cust_info' AS \"table\", cast(NULL AS string) AS other_table,"
        f" '{c}' AS columns, count(*) - count({c}) AS violations FROM raw_crm_cust_info"
        for c in BRONZE.tables["crm_cust_info"].names)),
)
def _(spark, sf_dir):
    names = tuple(BRONZE.tables["crm_cust_info"].names)
    return checks.null_keys(raw(spark, sf_dir, "crm_cust_info"), "crm_cust_info", names)


@query(
    "duplicate_key_check",
    """SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def _(spark, sf_dir):
    return checks.duplicate_keys(given(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


_PRODUCT_KEY = Reference("crm_sales_details", "sls_prd_key", "crm_prd_info", "prd_key")


@query(
    "orphan_check",
    over("crm_sales_details", """SELECT s.sls_prd_key AS key, count(*) AS rows FROM crm_sales_details s
LEFT JOIN (SELECT DISTINCT CASE WHEN prd_line = 'Road' THEN prd_key ELSE 'ex-' || prd_key END AS prd_key
           FROM crm_prd_info) t ON s.sls_prd_key = t.prd_key
WHERE t.prd_key IS NULL GROUP BY 1"""),
)
def _(spark, sf_dir):
    tables = Silver(spark, sf_dir)
    # Only road products keep their key, so that there are orphans.
    kept = F.when(F.col("prd_line") == "Road", F.col("prd_key")).otherwise(F.concat(F.lit("ex-"), F.col("prd_key")))
    return checks.orphan_keys(tables["crm_sales_details"], tables["crm_prd_info"].withColumn("prd_key", kept), _PRODUCT_KEY)


@query(
    "orphan_rows",
    f"""SELECT r.* FROM ({_ORDERS.format(orders='orders')}) r LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem) l
ON r.record = l.l_orderkey WHERE l.l_orderkey IS NULL""",
)
def _(spark, sf_dir):
    ref = Reference("records", "record", "lineitem", "l_orderkey")
    return checks.orphan_rows(derive(spark, sf_dir, _ORDERS), given(spark, sf_dir, "lineitem"), ref)


@query(
    "orphan_check_allow_null",
    f"""SELECT r.record AS key, count(*) AS rows FROM ({_ORDERS.format(orders='orders')}) r
LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem) l ON r.record = l.l_orderkey
WHERE l.l_orderkey IS NULL AND r.record IS NOT NULL GROUP BY 1""",
)
def _(spark, sf_dir):
    ref = Reference("records", "record", "lineitem", "l_orderkey", allow_null=True)
    return checks.orphan_keys(derive(spark, sf_dir, _ORDERS), given(spark, sf_dir, "lineitem"), ref)


@query("constraint_report", over("crm_cust_info crm_sales_details erp_px_cat_g1v2", oracles.report("silver")))
def _(spark, sf_dir):
    return checks.constraint_report(SILVER, written_silver(spark, sf_dir))


@query("constraint_report_gold", over("fact_sales", oracles.report("gold")))
def _(spark, sf_dir):
    return checks.constraint_report(GOLD, written_gold(spark, sf_dir))


@query(
    "status_rollup_table",
    over("erp_px_cat_g1v2", f"""SELECT marked AS "table",
  CASE WHEN bool_or("check" = 'reference' AND violations > 0) THEN 'FAIL' ELSE 'PASS' END AS referential_integrity,
  CASE WHEN bool_or("check" = 'null_key' AND violations > 0) THEN 'FAIL' ELSE 'PASS' END AS null_key_check,
  CASE WHEN bool_or("check" = 'duplicate_key' AND violations > 0) THEN 'FAIL' ELSE 'PASS' END AS duplicate_key_check,
  CASE WHEN bool_or(violations > 0) THEN 'FAILED' ELSE 'SUCCESS' END AS validation_status
FROM (SELECT "table" AS marked, "check", violations FROM ({oracles.report('silver')})
      UNION ALL SELECT other_table, "check", violations FROM ({oracles.report('silver')}) WHERE other_table IS NOT NULL)
GROUP BY marked"""),
)
def _(spark, sf_dir):
    return checks.status_per_table(checks.constraint_report(SILVER, written_silver(spark, sf_dir)))


@query(
    "status_rollup_layer",
    over("fact_sales", f""", report AS ({oracles.report('gold')})
SELECT DISTINCT "table", CASE WHEN (SELECT max(violations) FROM report) > 0 THEN 'FAILED' ELSE 'SUCCESS' END AS validation_status
FROM report"""),
)
def _(spark, sf_dir):
    return checks.status_for_layer(written(checks.constraint_report(GOLD, written_gold(spark, sf_dir))))


@query(
    "width_check",
    over("raw_erp_px_cat_g1v2", " UNION ALL ".join(
        f"SELECT 'width' AS \"check\", '{t}' AS \"table\", cast(NULL AS string) AS other_table,"
        f" '{f.name}' AS columns, count(*) FILTER (WHERE length({f.name}) > {f.metadata['width']}) AS violations FROM raw_{t}"
        for t in RAW for f in BRONZE.tables[t])),
)
def _(spark, sf_dir):
    return reduce(DataFrame.union, [checks.width_check(raw(spark, sf_dir, t), t, BRONZE.tables[t]) for t in RAW])


# -- reconciliation ------------------------------------------------------------------------------

_OUTCOME = """CASE WHEN right_rows IS NULL THEN 'ONLY_LEFT' WHEN left_rows IS NULL THEN 'ONLY_RIGHT'
       WHEN left_rows <> right_rows THEN 'COUNT_MISMATCH' ELSE 'MATCH' END AS outcome"""


def _counts(prefix: str) -> str:
    return " UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS rows FROM {prefix}{t}" for t in RAW)


@query(
    "row_reconciliation",
    over("crm_sales_details erp_px_cat_g1v2", f"""SELECT "table", left_rows, right_rows, {_OUTCOME}
FROM (SELECT coalesce(a."table", b."table") AS "table", a.rows AS left_rows, b.rows AS right_rows
      FROM ({_counts('raw_')}) a FULL JOIN ({_counts('')}) b ON a."table" = b."table")"""),
)
def _(spark, sf_dir):
    bronze = {t: raw(spark, sf_dir, t) for t in RAW}
    return reconcile.reconcile_tables(bronze, dict(Silver(spark, sf_dir)))


@query(
    "key_counts",
    f"""SELECT key, left_rows, right_rows, {_OUTCOME}
FROM (SELECT coalesce(a.key, b.key) AS key, a.rows AS left_rows, b.rows AS right_rows
      FROM (SELECT CASE WHEN o_orderstatus = 'P' THEN -o_orderkey ELSE o_orderkey END AS key, count(*) AS rows
            FROM orders GROUP BY 1) a
      FULL JOIN (SELECT l_orderkey AS key, count(*) AS rows FROM lineitem GROUP BY 1) b ON a.key = b.key)""",
)
def _(spark, sf_dir):
    # Pending orders get another key, so that there are keys on one side only.
    key = F.when(F.col("o_orderstatus") == "P", -F.col("o_orderkey")).otherwise(F.col("o_orderkey"))
    placed = given(spark, sf_dir, "orders").select(key.alias("key"))
    shipped = given(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("key"))
    return reconcile.reconcile(placed, shipped, ["key"])


@query(
    "key_set_diff",
    over("crm_cust_info erp_cust_az12", """SELECT key, 'ONLY_LEFT' AS outcome FROM (
  SELECT cst_key AS key FROM crm_cust_info EXCEPT SELECT cid FROM erp_cust_az12)
UNION ALL SELECT key, 'ONLY_RIGHT' FROM (SELECT cid AS key FROM erp_cust_az12 EXCEPT SELECT cst_key FROM crm_cust_info)"""),
)
def _(spark, sf_dir):
    tables = Silver(spark, sf_dir)
    crm = tables["crm_cust_info"].select(F.col("cst_key").alias("key"))
    erp = tables["erp_cust_az12"].select(F.col("cid").alias("key"))
    return reconcile.key_set_difference(crm, erp, ["key"])


# Order lines as one system has them and as another does: a hundredth doubled, as many missing, some changed.
_LINES_HERE = """SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, cast(l_quantity AS decimal(18,2)) AS l_quantity,
       cast(l_extendedprice AS decimal(18,2)) AS l_extendedprice, CASE WHEN l_partkey % 7 > 0 THEN l_linestatus END AS l_linestatus
FROM {lineitem}"""
_LINES_THERE = f"""SELECT l_orderkey, CASE WHEN l_orderkey % 101 = 5 AND l_linenumber = 2 THEN 1 ELSE l_linenumber END AS l_linenumber,
       CASE WHEN l_orderkey % 101 = 5 AND l_linenumber = 2 THEN first_part ELSE l_partkey END AS l_partkey,
       CASE WHEN l_orderkey % 101 = 5 AND l_linenumber = 2 THEN first_flag ELSE l_returnflag END AS l_returnflag,
       CASE WHEN l_orderkey % 101 = 5 AND l_linenumber = 2 THEN first_quantity
            WHEN l_orderkey % 211 = 9 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity,
       CASE WHEN l_orderkey % 101 = 5 AND l_linenumber = 2 THEN first_price ELSE l_extendedprice END AS l_extendedprice,
       CASE WHEN l_orderkey % 101 = 5 AND l_linenumber = 2 THEN first_status
            WHEN l_orderkey % 307 = 4 THEN NULL ELSE l_linestatus END AS l_linestatus
FROM ({_LINES_HERE}) lines LEFT JOIN (
  SELECT l_orderkey AS first_key, min(l_partkey) AS first_part, min(l_returnflag) AS first_flag, min(l_quantity) AS first_quantity,
         min(l_extendedprice) AS first_price, min(l_linestatus) AS first_status
  FROM ({_LINES_HERE}) firsts WHERE l_linenumber = 1 GROUP BY l_orderkey
) firsts ON l_orderkey = first_key"""


@query(
    "content_differences",
    f"""WITH here AS ({_LINES_HERE.format(lineitem="lineitem")}), there AS ({_LINES_THERE.format(lineitem="lineitem")})
SELECT COLUMNS(* EXCLUDE (left_rows, right_rows)), sum(left_rows)::BIGINT AS left_rows, sum(right_rows)::BIGINT AS right_rows FROM (
  SELECT *, 1 AS left_rows, 0 AS right_rows FROM (SELECT * FROM here EXCEPT ALL SELECT * FROM there)
  UNION ALL SELECT *, 0, 1 FROM (SELECT * FROM there EXCEPT ALL SELECT * FROM here)
  UNION ALL SELECT *, 1, 1 FROM (SELECT * FROM here INTERSECT ALL SELECT * FROM there)
) GROUP BY ALL HAVING sum(left_rows) <> sum(right_rows)""",
)
def _(spark, sf_dir):
    return changes.content_differences(derive(spark, sf_dir, _LINES_HERE), derive(spark, sf_dir, _LINES_THERE))


# -- delimited files -----------------------------------------------------------------------------


def without_cr(df: DataFrame) -> DataFrame:
    """The rows as a reader sees them that takes CRLF for the row end."""
    return df.withColumn(df.columns[-1], text.strip_cr(F.col(df.columns[-1])))


def file_of(table: str) -> str:
    """``crm_cust_info`` -> ``source_crm/cust_info.csv``."""
    return "source_{}/{}.csv".format(*table.split("_", 1))


def as_files(spark: SparkSession, sf_dir: str, texts: Mapping[str, str]) -> str:
    """Write raw tables, given by their texts, as unquoted comma-separated CRLF files below a new folder.

    Written together, so that the small ones don't keep the cluster waiting one after the other.
    """
    root = f"{scratch_folder(spark)}/files-{uuid.uuid4().hex}"
    frames = {table: without_cr(derive(spark, sf_dir, sql)) for table, sql in texts.items()}

    def write(table: str) -> None:
        frames[table].write.options(
            header=True, quote="", escapeQuotes=False, emptyValue="", nullValue="", lineSep="\r\n",
            ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        ).csv(f"{root}/{file_of(table)}")

    with ThreadPoolExecutor(len(frames)) as pool:
        list(pool.map(write, frames))
    return root


def _fields(table: str) -> str:
    return ", ".join(f"nullif({c}, '') AS {c}" for c in oracles.columns_of(table))


for _table in RAW:
    query(f"delimited_scan_{_table}", over(f"raw_{_table}", f"SELECT {_fields(_table)} FROM raw_{_table}"))(
        lambda spark, sf_dir, table=_table: delimited.read_delimited(
            spark,
            delimited.tables_found(spark, as_files(spark, sf_dir, {table: RAW[table]}))[table],
            BRONZE.tables[table],
        )
    )


@query(
    "source_line_counts",
    over("raw_erp_px_cat_g1v2", " UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", count(*) AS rows FROM raw_{t}" for t in RAW)),
)
def _(spark, sf_dir):
    return delimited.source_line_counts(spark, as_files(spark, sf_dir, RAW)).groupBy("table").agg(F.sum("rows").alias("rows"))


@query(
    "empty_files",
    over("raw_erp_px_cat_g1v2", " UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", count(*) AS rows, 1 AS folders FROM raw_{t}"
        f" UNION ALL SELECT '{t}_none', 0, 1" for t in RAW)),
)
def _(spark, sf_dir):
    """Beside each table's file one of zero bytes: found as a table without rows, loaded by its schema."""
    root = as_files(spark, sf_dir, RAW)
    for table in RAW:
        nothing = spark.createDataFrame([], "line string").coalesce(1)
        nothing.write.csv(f"{root}/{file_of(table).removesuffix('.csv')}_none.csv")
    found = delimited.tables_found(spark, root)
    loaded = [
        delimited.read_delimited(spark, paths, BRONZE.tables[table.removesuffix("_none")])
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(table).alias("table"), "rows", F.lit(len(paths)).alias("folders"))
        for table, paths in found.items()
    ]
    return reduce(DataFrame.unionAll, loaded)


def as_uneven_files(spark: SparkSession, sf_dir: str) -> str:
    """Write the raw tables as files in which a line, by its length, gains a field, loses its last one or is blank."""
    root = f"{scratch_folder(spark)}/files-{uuid.uuid4().hex}"
    for table in RAW:
        rows = without_cr(raw(spark, sf_dir, table))
        line = F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in rows.columns])
        kind = F.length(line) % 10
        uneven = (
            F.when(kind == 0, F.concat(line, F.lit(",surplus")))
            .when(kind == 1, F.regexp_replace(line, ",[^,]*$", ""))
            .when(kind == 2, F.lit("  "))
            .otherwise(line)
        )
        # One text column named like the whole header; a separator that no line has.
        rows.select(uneven.alias(",".join(rows.columns))).write.options(
            header=True, sep="\u0001", quote="", escapeQuotes=False, emptyValue="", lineSep="\n",
            ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        ).csv(f"{root}/{file_of(table)}")
    return root


def _uneven(table: str) -> str:
    *others, last = oracles.columns_of(table)
    cells = [f"coalesce({c}, '')" for c in others] + [f"coalesce(trim({last}, chr(13)), '')"]
    line = " || ',' || ".join(cells)
    return f"SELECT '{table}' AS \"table\", length({line}) % 10 AS kind FROM raw_{table}"


_LINES = "(" + " UNION ALL ".join(_uneven(t) for t in RAW) + ")"


@query(
    "bad_line_report",
    over("raw_erp_px_cat_g1v2", f"""SELECT "table", count(*) AS rows, count(*) FILTER (kind < 3) AS malformed
FROM {_LINES} GROUP BY "table\""""),
)
def _(spark, sf_dir):
    fields = {t: len(BRONZE.tables[t]) for t in RAW}
    lines = delimited.source_line_counts(spark, as_uneven_files(spark, sf_dir), fields=fields)
    return lines.groupBy("table").agg(F.sum("rows").alias("rows"), F.sum("malformed").alias("malformed"))


@query(
    "file_reconciliation",
    over("raw_erp_px_cat_g1v2", f"""SELECT "table", left_rows, right_rows, {_OUTCOME}
FROM (SELECT "table", count(*) AS left_rows, nullif(count(*) FILTER (kind <> 2), 0) AS right_rows FROM {_LINES} GROUP BY "table")"""),
)
def _(spark, sf_dir):
    """Lines in files against rows loaded from them: the scan skips blank lines, the comparison shows it."""
    root = as_uneven_files(spark, sf_dir)
    found = delimited.tables_found(spark, root)
    loaded = written_all({t: delimited.read_delimited(spark, found[t], BRONZE.tables[t]) for t in RAW})
    rows = reduce(DataFrame.union, [reconcile.row_count(df, t) for t, df in loaded.items()]).where("rows > 0")
    return reconcile.reconcile(
        delimited.source_line_counts(spark, root), rows, ["table"], F.col("rows"), F.col("rows")
    )


@query(
    "profile_files",
    over("raw_erp_px_cat_g1v2", "\nUNION ALL\n".join(
        f"SELECT * FROM ({oracles.profile(oracles.without_cr(t), t, oracles.columns_of(t))})" for t in RAW)),
)
def _(spark, sf_dir):
    return delimited.profile_files(spark, as_files(spark, sf_dir, RAW))


@query(
    "range_clustered_load",
    """SELECT 0::BIGINT AS overlaps, true AS several_files, count(*) AS rows, min(l_orderkey) AS first, max(l_orderkey) AS last,
       count(DISTINCT l_orderkey) AS keys FROM lineitem""",
)
def _(spark, sf_dir):
    """Order lines written in ranges of their order, and what the files hold by reading them back."""
    path = f"{scratch_folder(spark)}/clustered-{uuid.uuid4().hex}"
    lines = given(spark, sf_dir, "lineitem")
    reload(lines, lines.schema, path, ["l_orderkey"], files=16)
    ranges = written(file_ranges(spark.read.parquet(path), "l_orderkey"))
    keys = spark.read.parquet(path).agg(F.countDistinct("l_orderkey")).first()[0]
    return ranges.agg(
        F.count_if(F.col("first") < F.col("before")).alias("overlaps"),
        (F.count(F.lit(1)) > 1).alias("several_files"),
        F.sum("rows").alias("rows"), F.min("first").alias("first"), F.max("last").alias("last"),
        F.lit(keys).cast("long").alias("keys"),
    )


# -- the whole refresh ---------------------------------------------------------------------------


def new_warehouse(spark: SparkSession) -> Warehouse:
    return Warehouse(spark, f"{scratch_folder(spark)}/warehouse-{uuid.uuid4().hex}")


def refreshed(spark: SparkSession, sf_dir: str) -> Refresh:
    """A full refresh over files that pass every check, into a warehouse of its own."""
    warehouse = new_warehouse(spark)
    run_id, _ = refresh_all(warehouse, as_files(spark, sf_dir, SOUND))
    return Refresh(warehouse, run_id)


for _table, _schema in GOLD.tables.items():
    query(f"refresh_{_table}", over(_table, f"SELECT {', '.join(_schema.names)} FROM {_table}", SOUND))(
        lambda spark, sf_dir, table=_table: refreshed(spark, sf_dir).warehouse.spark.table(f"gold.{table}")
    )


def _step(layer: str, table: str, read: str | None, written_rows: str) -> str:
    verdict = "'PASS'" if layer == "silver" else "cast(NULL AS string)"
    return (
        f"SELECT '{layer}' AS layer, '{layer}.load_{table}' AS step, 'SUCCESS' AS status, 'SUCCESS' AS validation_status,"
        f" (SELECT count(*) FROM {read}) AS rows_read, (SELECT count(*) FROM {written_rows}) AS rows_written,"
        f" {verdict} AS referential_integrity, {verdict} AS null_key_check, {verdict} AS duplicate_key_check"
    )


@query(
    "refresh_state",
    over("fact_sales", " UNION ALL ".join(
        [_step("bronze", t, f"raw_{t}", f"raw_{t}") for t in BRONZE.tables]
        + [_step("silver", t, f"raw_{t}", t) for t in SILVER.tables]
        + [_step("gold", t, source, t) for t, source in (
            ("dim_customer", "crm_cust_info"), ("dim_product", "crm_prd_info"), ("fact_sales", "crm_sales_details"))]
    ), SOUND),
)
def _(spark, sf_dir):
    return refreshed(spark, sf_dir).state().select(
        "layer", "step", "status", "validation_status", "rows_read", "rows_written",
        "referential_integrity", "null_key_check", "duplicate_key_check",
    )


_STATE_SQL = ORACLES["refresh_state"]


@query("refresh_resumed", _STATE_SQL)
def _(spark, sf_dir):
    """The same run in two halves: the second process takes it up behind bronze."""
    warehouse = new_warehouse(spark)
    source = as_files(spark, sf_dir, SOUND)
    first = Refresh.start(warehouse)
    first.load_bronze(source)
    first.check_bronze(source)
    second = Refresh.resume(warehouse, "bronze")
    second.expect_loaded(BRONZE)
    second.load_silver()
    second.check_silver()
    second.load_gold()
    second.check_gold()
    return second.state().where(F.col("run_id") == first.run_id).select(
        "layer", "step", "status", "validation_status", "rows_read", "rows_written",
        "referential_integrity", "null_key_check", "duplicate_key_check",
    )


_LACKING = "(SELECT count(*) FROM crm_prd_info WHERE cat_id NOT IN (SELECT id FROM erp_px_cat_g1v2)) > 0"


def _checked_step(table: str) -> str:
    hit = _LACKING if table in ("crm_prd_info", "erp_px_cat_g1v2") else "false"
    return (
        f"SELECT 'silver' AS layer, 'silver.load_{table}' AS step, 'SUCCESS' AS status,"
        f" CASE WHEN {hit} THEN 'FAILED' ELSE 'SUCCESS' END AS validation_status,"
        f" CASE WHEN {hit} THEN 'FAIL' ELSE 'PASS' END AS referential_integrity,"
        f" (SELECT count(*) FROM raw_{table}) AS rows_read, (SELECT count(*) FROM {table}) AS rows_written, false AS published"
    )


@query("refresh_stopped_by_checks", over("fact_sales", " UNION ALL ".join(map(_checked_step, SILVER.tables)), ORPHANED))
def _(spark, sf_dir):
    """A refresh whose silver checks fail: what the run log says, that nothing of it is published, no gold steps."""
    warehouse = new_warehouse(spark)
    for layer in (BRONZE, SILVER, GOLD):
        warehouse.create_if_absent(layer)
    try:
        refresh_all(warehouse, as_files(spark, sf_dir, ORPHANED))
    except checks.ValidationFailed as stopped:
        assert stopped.layer == "silver"
    else:
        raise AssertionError("the checks let missing categories pass")
    published = any(not spark.table(f"silver.{t}").isEmpty() for t in warehouse.listed("silver"))
    return Refresh(warehouse, "").state().where("layer <> 'bronze'").select(
        "layer", "step", "status", "validation_status", "referential_integrity", "rows_read", "rows_written",
        F.lit(published).alias("published"),
    )


def _loaded_step(table: str) -> str:
    broken = "(SELECT count(*) FROM raw_crm_sales_details WHERE sls_quantity = '2000000') > 0" if table == "crm_sales_details" else "false"
    counted = lambda t: f"CASE WHEN NOT {broken} THEN (SELECT count(*) FROM {t}) END"
    # The lines that fail are not typed here: that table's own rows are counted only where none fails.
    written_rows = "raw_crm_sales_details" if table == "crm_sales_details" else table
    return (
        f"SELECT 'silver.load_{table}' AS step, CASE WHEN {broken} THEN 'FAILED' ELSE 'SUCCESS' END AS status,"
        f" CASE WHEN {broken} THEN 'DATA QUALITY' END AS error_class,"
        f" {counted('raw_' + table)} AS rows_read, {counted(written_rows)} AS rows_written"
    )


@query("refresh_broken_step", over("fact_sales", " UNION ALL ".join(map(_loaded_step, SILVER.tables)), TOO_LARGE))
def _(spark, sf_dir):
    """A load that fails on amounts beyond their type: it is logged with its class, the others end."""
    run = Refresh.start(new_warehouse(spark))
    run.load_bronze(as_files(spark, sf_dir, TOO_LARGE))
    try:
        run.load_silver()
    except Exception as error:  # logged with its class, which the result shows
        assert runlog.exception_class(error) == "DATA QUALITY"
    else:
        raise AssertionError("amounts beyond their type were loaded")
    return run.state().where("layer = 'silver'").select("step", "status", "error_class", "rows_read", "rows_written")


@query(
    "layer_listing",
    over("fact_sales", " UNION ALL ".join(
        f"SELECT '{layer.name}' AS layer, '{t}' AS \"table\", (SELECT count(*) FROM {'raw_' if layer is BRONZE else ''}{t}) AS rows"
        for layer in (BRONZE, SILVER, GOLD) for t in layer.tables), SOUND),
)
def _(spark, sf_dir):
    """The tables each layer offers after a refresh, and the rows behind each name."""
    warehouse = refreshed(spark, sf_dir).warehouse
    for layer in (BRONZE, SILVER, GOLD):
        warehouse.create_if_absent(layer)  # leaves what is published
    listed = [(layer, table) for layer in ("bronze", "silver", "gold") for table in warehouse.listed(layer)]
    return reduce(DataFrame.unionAll, [
        spark.table(f"{layer}.{table}").agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(layer).alias("layer"), F.lit(table).alias("table"), "rows")
        for layer, table in listed
    ])


def refreshed_by_changes(spark: SparkSession, sf_dir: str) -> Incremental:
    """Everything loaded from one extract, then the changed keys of the next."""
    tables = Incremental(spark, f"{scratch_folder(spark)}/incremental-{uuid.uuid4().hex}")
    # Extracts are given, as files are: derived once, the next one from the first by its changes.
    extract = written_all({t: derive(spark, sf_dir, sql, {"lineitem": "l_orderkey"}) for t, sql in SOUND.items()})
    tables.first(extract)
    tables.refresh({t: changed(df, CHANGES[t]) if t in CHANGES else df for t, df in extract.items()})
    return tables


for _table, _schema in GOLD.tables.items():
    query(f"incremental_{_table}", over(_table, f"SELECT {', '.join(_schema.names)} FROM {_table}", NEXT))(
        lambda spark, sf_dir, table=_table: refreshed_by_changes(spark, sf_dir).gold(table).read()
    )


# -- profiling -----------------------------------------------------------------------------------

for _table in RAW:
    query(
        f"profile_{_table}",
        over(f"raw_{_table}", oracles.profile(oracles.without_cr(_table), _table, oracles.columns_of(_table))),
    )(lambda spark, sf_dir, table=_table: profile.profile(without_cr(raw(spark, sf_dir, table)), table))

_REPORTED = ["name", "column", "max_length", "min_length", "null_count", "cardinality", "row_count", "top_values", "data_type"]


@query(
    "report_read_back",
    over("raw_crm_sales_details", "SELECT " + ", ".join(f'cast("{c}" AS string) AS "{c}"' for c in _REPORTED) + " FROM ("
         + oracles.profile(oracles.without_cr("crm_sales_details"), "crm_sales_details", oracles.columns_of("crm_sales_details"))
         + ")"),
)
def _(spark, sf_dir):
    """A profile written as a delimited report, as text from the report's files."""
    path = f"{scratch_folder(spark)}/report-{uuid.uuid4().hex}"
    delimited.write_report(profile.profile(without_cr(raw(spark, sf_dir, "crm_sales_details")), "crm_sales_details"), path)
    return spark.read.option("header", True).csv(path).select(*_REPORTED)


_MIXED = """SELECT o_orderkey, o_orderstatus, cast(o_orderdate AS date) AS o_orderdate,
       CASE WHEN o_orderkey % 2 = 0 THEN 'True' ELSE 'False' END AS is_even,
       CASE WHEN o_orderkey % 3 = 0 THEN '1' WHEN o_orderkey % 3 = 1 THEN '0' ELSE 'NA' END AS bit,
       CASE WHEN o_orderkey % 3 = 0 THEN 'n/k' ELSE cast(o_custkey AS string) END AS mostly_number,
       CASE WHEN o_orderkey % 3 = 0 THEN 'soon' ELSE cast(o_orderdate AS string) END AS mostly_date,
       CASE WHEN o_orderkey % 3 > 0 THEN 'soon' ELSE cast(o_orderdate AS string) END AS rarely_date,
       '' AS blank, o_orderpriority FROM {orders}"""
_MIXED_COLUMNS = [
    "o_orderkey", "o_orderstatus", "o_orderdate", "is_even", "bit", "mostly_number", "mostly_date", "rarely_date",
    "blank", "o_orderpriority",
]


@query(
    "profile_types",
    f"WITH mixed AS ({_MIXED.format(orders='orders')}) " + oracles.profile("mixed", "mixed", _MIXED_COLUMNS),
)
def _(spark, sf_dir):
    return profile.profile(derive(spark, sf_dir, _MIXED), "mixed")


_EXACT_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus"]


@query(
    "profile_top3",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", string_agg(value || '(' || n || ')', ', ' ORDER BY n DESC, value) AS top_values"
        f" FROM (SELECT cast({c} AS string) AS value, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, value LIMIT 3)"
        for c in _EXACT_COLUMNS),
)
def _(spark, sf_dir):
    # Every column but those of type double and timestamp, whose text differs from engine to engine: see the next query.
    return profile.top_values(profile.value_counts(given(spark, sf_dir, "lineitem").select(*_EXACT_COLUMNS)))


# The other columns of lineitem, in a text that all engines write alike.
_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "profile_top3_measures",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", string_agg(value || '(' || n || ')', ', ' ORDER BY n DESC, value) AS top_values"
        f" FROM (SELECT {text} AS value, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, value LIMIT 3)"
        for c, text in [
            *[(c, f"cast(cast({c} AS decimal(18,6)) AS string)") for c in _MEASURES],
            ("l_shipdate", "strftime(l_shipdate, '%Y-%m-%d %H:%M:%S.%f')"),
        ]),
)
def _(spark, sf_dir):
    texts = [F.col(c).cast("decimal(18,6)").cast("string").alias(c) for c in _MEASURES]
    texts.append(F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("l_shipdate"))
    return profile.top_values(profile.value_counts(given(spark, sf_dir, "lineitem").select(*texts)))


# All columns of lineitem as text that all engines write alike: (column, in the checking engine, in Spark).
_LINE_TEXTS = [
    *[(c, f"cast({c} AS string)", f"cast({c} AS string)") for c in _EXACT_COLUMNS],
    *[(c, *[f"cast(cast({c} AS decimal(18,6)) AS string)"] * 2) for c in _MEASURES],
    ("l_shipdate", "strftime(l_shipdate, '%Y-%m-%d %H:%M:%S.%f')", "date_format(l_shipdate, 'yyyy-MM-dd HH:mm:ss.SSSSSS')"),
]


def line_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given(spark, sf_dir, "lineitem").selectExpr(*[f"{sql} AS {c}" for c, _, sql in _LINE_TEXTS])


@query(
    "profile_frequent",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", string_agg(value || '(' || n || ')', ', ' ORDER BY n DESC, value) AS top_values"
        f" FROM (SELECT {sql} AS value, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, value LIMIT 3)"
        for c, sql, _ in _LINE_TEXTS),
)
def _(spark, sf_dir):
    """The three most frequent values of all columns, by counters that are bounded whatever the cardinality."""
    return profile.top_values(frequent.frequent_values(line_texts(spark, sf_dir)))


@query(
    "profile_distinct_sketch",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(DISTINCT {sql}) AS cardinality, true AS within_3_percent FROM lineitem"
        for c, sql, _ in _LINE_TEXTS),
)
def _(spark, sf_dir):
    """Seven runs' sketches, kept and merged, beside the exact count: their error is part of the result."""
    path = f"{scratch_folder(spark)}/sketches-{uuid.uuid4().hex}"
    texts = written(line_texts(spark, sf_dir))
    for run in [r[0] for r in texts.select("l_linenumber").distinct().collect()]:
        sketches.keep(texts.where(F.col("l_linenumber") == run), path, f"run-{run}")
    about = sketches.merged(sketches.kept(spark, path)).withColumnRenamed("cardinality", "about")
    exact = frequent.cells_of(texts).distinct().groupBy("column").agg(F.count("value").alias("cardinality"))
    close = F.abs(F.col("about") - F.col("cardinality")) <= 0.03 * F.col("cardinality")
    return exact.join(about, "column", "left").select("column", "cardinality", F.coalesce(close, F.lit(False)).alias("within_3_percent"))


_DAY = "lpad(cast(day(o_orderdate) AS string), 2, '0')"
_LOW_DAY = "lpad(cast(1 + day(o_orderdate) % 12 AS string), 2, '0')"
_MONTH = "lpad(cast(month(o_orderdate) AS string), 2, '0')"
_YEAR = "cast(year(o_orderdate) AS string)"
_MONTH_NAME = "substring('JanFebMarAprMayJunJulAugSepOctNovDec', cast(month(o_orderdate) AS int) * 3 - 2, 3)"
# One column per format, two in which day and month cannot be told apart, one of a few dates among other text.
_DATE_TEXTS = {
    "iso": f"{_YEAR} || '-' || {_MONTH} || '-' || {_DAY}",
    "iso_time": f"{_YEAR} || '-' || {_MONTH} || '-' || {_DAY} || ' 23:59:07'",
    "compact": f"{_YEAR} || {_MONTH} || {_DAY}",
    "month_first": f"{_MONTH} || '/' || {_DAY} || '/' || {_YEAR}",
    "day_first": f"{_DAY} || '/' || {_MONTH} || '/' || {_YEAR}",
    "dotted": f"{_DAY} || '.' || {_MONTH} || '.' || {_YEAR}",
    "named": f"{_DAY} || ' ' || {_MONTH_NAME} || ' ' || {_YEAR}",
    "name_first": f"{_MONTH_NAME} || ' ' || {_DAY} || ', ' || {_YEAR}",
    "low_day_first": f"{_LOW_DAY} || '/' || {_MONTH} || '/' || {_YEAR}",
    "low_month_first": f"{_MONTH} || '/' || {_LOW_DAY} || '/' || {_YEAR}",
    "a_third": f"CASE WHEN o_orderkey % 3 = 0 THEN {_DAY} || '.' || {_MONTH} || '.' || {_YEAR} WHEN o_orderkey % 3 = 1 THEN '31.02.' || {_YEAR} ELSE 'soon' END",
    "never": "CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END",
}
_STRPTIME = {
    "yyyy-MM-dd": "%Y-%m-%d", "yyyy-MM-dd HH:mm:ss": "%Y-%m-%d %H:%M:%S", "yyyyMMdd": "%Y%m%d", "M/d/yyyy": "%m/%d/%Y",
    "d/M/yyyy": "%d/%m/%Y", "d.M.yyyy": "%d.%m.%Y", "d MMM yyyy": "%d %b %Y", "MMM d, yyyy": "%b %d, %Y",
}


def _dates_sql() -> str:
    texts = ", ".join(f"{sql} AS {c}" for c, sql in _DATE_TEXTS.items())
    formats = " UNION ALL ".join(
        f"SELECT \"column\", {i} AS place, '{name}' AS name, count(*) AS all_values, count(try_strptime(value, '{form}')) AS n,"
        f" cast(min(try_strptime(value, '{form}')) AS date) AS first, cast(max(try_strptime(value, '{form}')) AS date) AS last"
        f" FROM cells GROUP BY \"column\""
        for i, (name, form) in enumerate(_STRPTIME.items())
    )
    return f"""WITH texts AS (SELECT {texts} FROM orders),
cells AS (UNPIVOT texts ON {', '.join(_DATE_TEXTS)} INTO NAME "column" VALUE value),
formats AS ({formats}),
best AS (SELECT *, max(n) OVER (PARTITION BY "column") AS most FROM formats QUALIFY n = most)
SELECT "column", max(all_values) AS "values", max(most) AS dates,
       CASE WHEN max(most) > 0 THEN string_agg(name, ' or ' ORDER BY place) END AS formats,
       max(most) > 0 AND count(*) > 1 AS ambiguous, max(most) * 2 > max(all_values) AS mostly,
       CASE WHEN max(most) > 0 AND count(*) = 1 THEN min(first) END AS first, CASE WHEN max(most) > 0 AND count(*) = 1 THEN max(last) END AS last
FROM best GROUP BY "column\""""


@query("date_formats", _dates_sql())
def _(spark, sf_dir):
    texts = ", ".join(f"{sql} AS {c}" for c, sql in _DATE_TEXTS.items())
    return dates.date_formats(derive(spark, sf_dir, f"SELECT {texts} FROM {{orders}}"))


# -- run log -------------------------------------------------------------------------------------


def run_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.current_state(derive(spark, sf_dir, RUN_EVENTS))


@query("run_current_state", over("run_state", "SELECT * FROM run_state"))
def _(spark, sf_dir):
    return run_state(spark, sf_dir)


for _layer in ("bronze", "silver", "gold"):
    query(
        f"latest_run_{_layer}",
        over("run_state", f"""SELECT * FROM (SELECT *, min(started_at) OVER (PARTITION BY run_id) AS batch_start FROM run_state) runs
WHERE layer = '{_layer}' AND batch_start = (
  SELECT max(b) FROM (SELECT min(started_at) AS b FROM run_state GROUP BY run_id))"""),
    )(lambda spark, sf_dir, layer=_layer: runlog.latest_run(run_state(spark, sf_dir), layer))


@query("run_state_compacted", over("run_state", "SELECT * FROM run_state"))
def _(spark, sf_dir):
    """The state told by a log that was appended to before and after it was compacted, some events twice."""
    path = f"{scratch_folder(spark)}/log-{uuid.uuid4().hex}"
    events = derive(spark, sf_dir, RUN_EVENTS)
    for layer in ("bronze", "silver", "bronze"):
        runlog.append_rows(events.where(F.col("layer") == layer), path)
    assert runlog.compact(spark, path) > 1
    runlog.append_rows(events.where("layer = 'gold'"), path)
    return runlog.current_state(runlog.read(spark, path)).select(*run_state(spark, sf_dir).columns)


@query("failed_steps", over("run_state", "SELECT * FROM run_state WHERE status <> 'SUCCESS'"))
def _(spark, sf_dir):
    return runlog.unfinished(run_state(spark, sf_dir))


@query(
    "classify_error",
    over("raw_run_events", """SELECT run_id, step, event_time,
       CASE WHEN severity >= 17 THEN 'INFRASTRUCTURE' WHEN error_number BETWEEN 4800 AND 4899 THEN 'INGESTION'
            WHEN error_number IN (2627,2601,547,515,8152,8114,8115,241,242,245,8169) THEN 'DATA QUALITY'
            WHEN error_number IN (208,207,102,201,2812,8144) THEN 'CODE' ELSE 'OTHER' END AS error_class,
       'Step failed: ' || step || ' | ' || coalesce(message, '') AS error_message FROM raw_run_events"""),
)
def _(spark, sf_dir):
    return derive(spark, sf_dir, RUN_EVENTS).select(
        "run_id",
        "step",
        "event_time",
        runlog.error_class(F.col("severity"), F.col("error_number")).alias("error_class"),
        runlog.failure_message(F.col("step"), F.col("message")).alias("error_message"),
    )


@query(
    "step_duration",
    over("run_state", """SELECT run_id, layer, count(*) AS steps, cast(sum(run_time_ms) AS bigint) AS run_time_ms,
       min(started_at) AS started_at FROM run_state GROUP BY run_id, layer"""),
)
def _(spark, sf_dir):
    return (
        run_state(spark, sf_dir)
        .groupBy("run_id", "layer")
        .agg(
            F.count(F.lit(1)).alias("steps"),
            F.sum("run_time_ms").alias("run_time_ms"),
            F.min("started_at").alias("started_at"),
        )
    )
