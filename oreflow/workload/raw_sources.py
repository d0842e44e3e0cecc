"""Dirty raw tables derived from the provided ones: stand-ins for the six CRM/ERP extracts.

The same text runs in Spark SQL and in the checking engine.  NULL is an empty field, blanks are
blanks, chr(13) the carriage return a CRLF file leaves on its last column.  ``{name}`` is a
provided table.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

TABLES = ("customer", "part", "orders", "lineitem", "events")

RAW = {
    "crm_cust_info": """
SELECT CASE WHEN c_custkey % 97 = 5 THEN NULL ELSE ' ' || cast(c_custkey + 11000 AS string) END AS cst_id,
       'AW000' || cast(c_custkey + 11000 AS string) AS cst_key,
       CASE WHEN c_custkey % 11 = 0 THEN '  ' ELSE ' ' || lower(c_mktsegment) || ' ' END AS cst_firstname,
       CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE upper(c_name) END AS cst_lastname,
       CASE c_custkey % 6 WHEN 0 THEN 'M' WHEN 1 THEN 's' WHEN 2 THEN ' Single ' WHEN 3 THEN NULL
            WHEN 4 THEN 'D' ELSE 'married' END AS cst_marital_status,
       CASE c_custkey % 5 WHEN 0 THEN 'F' WHEN 1 THEN 'm ' WHEN 2 THEN NULL WHEN 3 THEN 'u'
            ELSE 'Female' END AS cst_gndr,
       '2025-10-0' || cast(1 + c_custkey % 9 AS string) || chr(13) AS cst_create_date
FROM {customer}
UNION ALL
SELECT cast(c_custkey + 11000 AS string), 'AW000' || cast(c_custkey + 11000 AS string),
       lower(c_mktsegment), CASE WHEN c_custkey % 20 = 0 THEN NULL ELSE upper(c_name) END, 'S', 'F',
       CASE WHEN c_custkey % 30 = 10 THEN 'bad' ELSE '2026-01-15' END || chr(13)
FROM {customer} WHERE c_custkey % 10 = 0""",
    "crm_prd_info": """
SELECT cast(p_partkey * 3 + v + 1 AS string) AS prd_id,
       CASE p_partkey % 5 WHEN 1 THEN 'CO-PE' WHEN 4 THEN 'ZZ-ZZ'
            ELSE lpad(hex(p_partkey % 1048576), 5, '0') END || '-BK-' || lpad(cast(p_partkey AS string), 6, '0') AS prd_key,
       ' ' || p_name AS prd_nm,
       CASE WHEN p_partkey % 17 = 0 THEN NULL WHEN p_partkey % 7 = 0 THEN '-' ELSE '' END
         || cast(cast(p_retailprice AS decimal(10,2)) AS string) AS prd_cost,
       CASE p_partkey % 6 WHEN 0 THEN 'M' WHEN 1 THEN 'r ' WHEN 2 THEN 'T' WHEN 3 THEN 'S'
            WHEN 4 THEN 'Q' ELSE NULL END AS prd_line,
       CASE v WHEN 0 THEN '1995-07-01' WHEN 1 THEN '1997-07-01' ELSE '1999-07-01' END AS prd_start_dt,
       CASE WHEN v < p_partkey % 3 THEN '1994-12-31' WHEN p_partkey % 10 = 9 THEN '2000-12-31'
            ELSE '' END || chr(13) AS prd_end_dt
FROM (SELECT *, 0 AS v FROM {part}
      UNION ALL SELECT *, 1 FROM {part} WHERE p_partkey % 3 >= 1
      UNION ALL SELECT *, 2 FROM {part} WHERE p_partkey % 3 >= 2) p""",
    "crm_sales_details": """
SELECT CASE WHEN l_orderkey % 9 = 0 THEN '' ELSE 'SO' END || cast(l_orderkey AS string) AS sls_ord_num,
       CASE WHEN l_partkey % 211 = 3 THEN ' ' ELSE 'BK-' || lpad(cast(l_partkey AS string), 6, '0') END AS sls_prd_key,
       cast(o_custkey + 11000 AS string) AS sls_cust_id,
       CASE WHEN (l_orderkey + l_partkey) % 7 = 0 THEN '0'
            ELSE replace(cast(cast(o_orderdate AS date) AS string), '-', '') END AS sls_order_dt,
       CASE WHEN l_partkey % 53 = 0 THEN '20241340'
            ELSE replace(cast(cast(shipdate AS date) AS string), '-', '') END AS sls_ship_dt,
       replace(cast(cast(shipdate AS date) AS string), '-', '') AS sls_due_dt,
       CASE l_partkey % 10 WHEN 0 THEN NULL
            WHEN 1 THEN '-' || cast(cast(price * qty AS decimal(10,2)) AS string)
            WHEN 2 THEN '1.00' WHEN 3 THEN '-1.00'
            ELSE cast(cast(price * qty AS decimal(10,2)) AS string) END AS sls_sales,
       CASE WHEN l_partkey % 101 = 4 THEN NULL ELSE cast(qty AS string) END AS sls_quantity,
       CASE WHEN l_partkey % 20 IN (0, 5) THEN '' WHEN l_partkey % 10 = 6 THEN '-' || cast(price AS string)
            ELSE cast(price AS string) END || chr(13) AS sls_price
FROM (SELECT l_orderkey, l_partkey, min(l_shipdate) AS shipdate, cast(min(l_quantity) AS int) AS qty,
             cast(min(l_extendedprice) AS decimal(10,2)) AS price
      FROM {lineitem} GROUP BY l_orderkey, l_partkey) l
JOIN {orders} ON l_orderkey = o_orderkey""",
    "erp_cust_az12": """
SELECT CASE WHEN c_custkey % 2 = 0 THEN 'NAS' ELSE '' END || CASE WHEN c_custkey % 23 = 7 THEN 'AW999' ELSE 'AW000' END
         || cast(c_custkey + 11000 AS string) AS cid,
       CASE WHEN c_custkey % 19 = 0 THEN '1985-13-45'
            ELSE '19' || cast(50 + c_custkey % 50 AS string) || '-06-15' END AS bdate,
       CASE c_custkey % 5 WHEN 0 THEN 'Female' WHEN 1 THEN 'F' WHEN 2 THEN 'male ' WHEN 3 THEN ''
            ELSE 'x' END || chr(13) AS gen
FROM {customer}""",
    "erp_loc_a101": """
SELECT 'AW-000' || cast(c_custkey + 11000 AS string) AS cid,
       CASE c_nationkey % 9 WHEN 0 THEN 'Australia' WHEN 1 THEN 'ca' WHEN 2 THEN 'FR' WHEN 3 THEN ' DE'
            WHEN 4 THEN 'UK' WHEN 5 THEN 'United States' WHEN 6 THEN 'USA' WHEN 7 THEN 'Narnia'
            ELSE '' END || chr(13) AS cntry
FROM {customer}""",
    # One row per category; pedals' key is spelt otherwise in the products, and every fifth category is unused.
    "erp_px_cat_g1v2": """
SELECT CASE WHEN p_partkey % 5 = 1 THEN 'CO_PD' ELSE lpad(hex(p_partkey % 1048576), 5, '0') END AS id,
       max(CASE p_partkey % 5 WHEN 0 THEN 'Bikes' WHEN 1 THEN ' Components' WHEN 2 THEN 'Accessories'
                ELSE 'Clothing' END) AS cat,
       max(CASE p_partkey % 5 WHEN 2 THEN '  ' ELSE lower(p_type) || ' ' END) AS subcat,
       max(CASE p_partkey % 5 WHEN 0 THEN 'Yes' WHEN 1 THEN 'n' WHEN 2 THEN 'y ' ELSE 'maybe' END) || chr(13) AS maintenance
FROM {part} GROUP BY 1""",
}

# The same extracts without the faults that a check would stop a refresh for: every reference resolves, every
# text has its declared width, keys are unique.
SOUND = {
    **RAW,
    "crm_cust_info": """
SELECT cast(c_custkey + 11000 AS string) AS cst_id, 'AW000' || cast(c_custkey + 11000 AS string) AS cst_key,
       ' ' || lower(c_mktsegment) AS cst_firstname, upper(c_name) AS cst_lastname,
       CASE c_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 's' ELSE 'D' END AS cst_marital_status,
       CASE c_custkey % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'm ' ELSE NULL END AS cst_gndr,
       '2025-10-0' || cast(1 + c_custkey % 9 AS string) || chr(13) AS cst_create_date
FROM {customer}""",
    "crm_prd_info": RAW["crm_prd_info"].replace("'ZZ-ZZ'", "'CO-PE'"),
    "erp_cust_az12": RAW["erp_cust_az12"].replace("'AW999'", "'AW000'"),
    "erp_px_cat_g1v2": RAW["erp_px_cat_g1v2"].replace("'maybe'", "'no'"),
}

# The sound extract with products of a category that the catalogue lacks: the checks stop it behind silver.
ORPHANED = {**SOUND, "crm_prd_info": RAW["crm_prd_info"]}

# The sound extract with order lines whose amount does not fit its type: their load fails.
TOO_LARGE = {
    **SOUND,
    "crm_sales_details": f"""
SELECT sls_ord_num, sls_prd_key, sls_cust_id, sls_order_dt, sls_ship_dt, sls_due_dt,
       CASE WHEN large THEN '' ELSE sls_sales END AS sls_sales,
       CASE WHEN large THEN '2000000' ELSE sls_quantity END AS sls_quantity,
       CASE WHEN large THEN '99999999' || chr(13) ELSE sls_price END AS sls_price
FROM (SELECT *, cast(sls_cust_id AS int) % 100 = 9 AS large FROM ({SOUND["crm_sales_details"]}) s) s""",
}

# The next extract of the sound one, with about one row in a hundred changed: customers renamed or under a new key, a
# version that starts on another day, order lines with another quantity, a move to another country.  ``{extract}`` is the sound one.
CHANGES = {
    "crm_cust_info": """
SELECT cst_id, CASE WHEN cast(cst_id AS int) % 100 = 8 THEN 'AX' || substring(cst_key, 3) ELSE cst_key END AS cst_key,
       cst_firstname, CASE WHEN cast(cst_id AS int) % 100 = 7 THEN 'RENAMED' ELSE cst_lastname END AS cst_lastname,
       cst_marital_status, cst_gndr, cst_create_date
FROM ({extract}) s""",
    "crm_prd_info": """
SELECT prd_id, prd_key, prd_nm, prd_cost, prd_line,
       CASE WHEN cast(prd_id AS int) % 100 = 4 THEN '1997-08-15' ELSE prd_start_dt END AS prd_start_dt, prd_end_dt
FROM ({extract}) s""",
    "crm_sales_details": """
SELECT sls_ord_num, sls_prd_key, sls_cust_id, sls_order_dt, sls_ship_dt, sls_due_dt, sls_sales,
       CASE WHEN cast(sls_cust_id AS int) % 100 = 9 THEN '7' ELSE sls_quantity END AS sls_quantity, sls_price
FROM ({extract}) s""",
    "erp_loc_a101": """
SELECT cid, CASE WHEN right(cid, 2) = '13' THEN 'FR' || chr(13) ELSE cntry END AS cntry
FROM ({extract}) s""",
}

NEXT = {**SOUND, **{table: text.replace("{extract}", SOUND[table]) for table, text in CHANGES.items()}}

# One category row per part: the catalogue's cleaning rules over a table of full size.
PART_CATEGORIES = """
SELECT CASE WHEN p_partkey % 31 = 4 THEN '  ' ELSE lpad(cast(p_partkey AS string), 6, '0') END AS id,
       ' ' || p_type AS cat,
       CASE WHEN p_size % 10 = 3 THEN ' ' ELSE p_brand || ' ' || p_name END AS subcat,
       CASE p_size % 6 WHEN 0 THEN 'Yes' WHEN 1 THEN 'n' WHEN 2 THEN 'y ' WHEN 3 THEN 'maybe' WHEN 4 THEN ''
            ELSE 'NO' END || chr(13) AS maintenance
FROM {part}"""

# Run-log events: a run is a user, its steps the event types, three layers by event id.
RUN_EVENTS = """
SELECT 'run-' || cast(user_id AS string) AS run_id,
       CASE event_id % 3 WHEN 0 THEN 'bronze' WHEN 1 THEN 'silver' ELSE 'gold' END AS layer,
       'load_' || event_type AS step,
       ts AS event_time,
       ts AS started_at,
       CASE WHEN event_id % 4 > 0 THEN ts + INTERVAL 1500 MILLISECOND END AS ended_at,
       CASE event_id % 4 WHEN 0 THEN 'STARTED' WHEN 3 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
       CASE WHEN event_id % 5 = 2 THEN CASE WHEN value > 50 THEN 'FAILED' ELSE 'SUCCESS' END END AS validation_status,
       CASE WHEN event_id % 4 > 0 THEN event_id * 10 END AS rows_read,
       CASE WHEN event_id % 4 > 0 THEN event_id * 9 END AS rows_written,
       CASE event_id % 7 WHEN 0 THEN 'PASS' WHEN 1 THEN 'FAIL' END AS referential_integrity,
       CASE event_id % 7 WHEN 2 THEN 'PASS' WHEN 3 THEN 'FAIL' END AS null_key_check,
       CASE event_id % 7 WHEN 4 THEN 'PASS' WHEN 5 THEN 'FAIL' END AS duplicate_key_check,
       cast(10 + event_id % 10 AS int) AS severity,
       cast(CASE event_id % 13 WHEN 0 THEN 4832 WHEN 1 THEN 2627 WHEN 2 THEN 208 WHEN 3 THEN 4799 WHEN 4 THEN 4899
            WHEN 5 THEN 8114 WHEN 6 THEN 102 WHEN 7 THEN 245 WHEN 8 THEN 4900 WHEN 9 THEN 2812
            ELSE event_id % 400 END AS int) AS error_number,
       CASE WHEN event_id % 4 = 3 THEN event_type || ' broke' END AS message
FROM {events}"""


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derive(spark: SparkSession, sf_dir: str, text: str, near: Mapping[str, str] | None = None) -> DataFrame:
    """Run one of the texts above over the provided tables in ``sf_dir``.

    ``near`` names a column per table by which its rows are brought together first, for a text that groups by this column
    and others and then joins by it alone: both are done where the rows are then, and those of a key stay together.
    """
    used = {t: given(spark, sf_dir, t) for t in TABLES if f"{{{t}}}" in text}
    used |= {t: used[t].repartition(column) for t, column in (near or {}).items() if t in used}
    return spark.sql(text, **used)


def raw(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return derive(spark, sf_dir, RAW[table])


def changed(extract: DataFrame, text: str) -> DataFrame:
    """Run one of the texts of the changes over an extract that is there."""
    return extract.sparkSession.sql(text, extract=extract)


def as_checked(text: str) -> str:
    """The text for an engine in which the provided tables are views."""
    return text.format(**{t: t for t in TABLES})
