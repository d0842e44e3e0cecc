"""A refresh that works on changed keys only and ends with the tables of a full one.

Kept from run to run: the tables in buckets of keys, and a fingerprint of the raw rows of every key.  A run
fingerprints the new raw rows, finds the keys that differ, cleans the rows of those keys anew and rewrites the
buckets they lie in.  The fingerprints are replaced last, so a run that dies is repeated from the same changes.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.functions import text, values
from oreflow.operators.changes import fingerprints, key_changes
from oreflow.plans import gold, silver
from oreflow.schemas import GOLD, SILVER
from oreflow.session import sized, written, written_all
from oreflow.sources.buckets import BUCKETS, BucketTable

# Raw and silver rows of one group depend on no row of another.  Per silver table: the group of a silver row, and
# of a raw one.  Versions are chained by the first 18 characters of the full key, of which silver keeps those from 7.
GROUPS: dict[str, tuple[Callable[[], Column], Callable[[], Column]]] = {
    "crm_cust_info": (lambda: F.col("cst_key"), lambda: text.clip(text.clean(F.col("cst_key")), 10)),
    "crm_prd_info": (
        lambda: text.clip(F.col("prd_key"), 12),
        lambda: text.clip(text.tail(text.clean(F.col("prd_key")), 7), 12),
    ),
    "crm_sales_details": (
        lambda: F.col("sls_ord_num"),
        lambda: values.to_int(text.without_prefix(F.trim("sls_ord_num"), "SO")),
    ),
    "erp_cust_az12": (lambda: F.col("cid"), lambda: text.clip(text.from_first(text.clean(F.col("cid")), "AW"), 10)),
    "erp_loc_a101": (
        lambda: F.col("cid"),
        lambda: text.clip(F.replace(text.clean(F.col("cid")), F.lit("-"), F.lit("")), 10),
    ),
    "erp_px_cat_g1v2": (lambda: F.col("id"), lambda: text.clip(text.clean(F.col("id")), 5)),
}


def raw_group(table: str) -> Column:
    """The group of a raw row, as its cleaned row will name it."""
    return GROUPS[table][1]()


@dataclass
class Touched:
    """What a run rewrote: changed keys and rewritten buckets per table."""

    keys: dict[str, int] = field(default_factory=dict)
    buckets: dict[str, list[int]] = field(default_factory=dict)


@dataclass(frozen=True)
class Incremental:
    spark: SparkSession
    root: str
    buckets: int = BUCKETS

    def silver(self, table: str) -> BucketTable:
        return BucketTable(self.spark, f"{self.root}/silver/{table}", SILVER.tables[table], GROUPS[table][0], self.buckets)

    def gold(self, table: str) -> BucketTable:
        key = GOLD.keys[table][0]
        return BucketTable(self.spark, f"{self.root}/gold/{table}", GOLD.tables[table], lambda: F.col(key), self.buckets)

    def _prints_path(self, table: str, version: int) -> str:
        return f"{self.root}/fingerprints/{table}/version={version}"

    def _version(self) -> int:
        return self.spark.read.parquet(f"{self.root}/version").first()[0]

    def _prints(self, raw: Mapping[str, DataFrame], version: int) -> dict[str, DataFrame]:
        """Write the fingerprints of all raw rows where those of the version belong; none counts before ``_keep``."""
        out = {}
        for table in silver.TABLES:
            prints = fingerprints(raw[table], raw_group(table))
            prints.write.mode("overwrite").parquet(self._prints_path(table, version))
            out[table] = self.spark.read.schema(prints.schema).parquet(self._prints_path(table, version))
        return out

    def _keep(self, version: int) -> None:
        """Let the one row that names the version of the fingerprints change over."""
        self.spark.range(version, version + 1).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/version")

    def first(self, raw: Mapping[str, DataFrame]) -> None:
        """Load everything; ``raw`` is read from files."""
        for table, clean in silver.TABLES.items():
            self.silver(table).create(clean(sized(raw[table])))
        cleaned = gold.stored({table: self.silver(table).read() for table in silver.TABLES})
        self.gold("dim_customer").create(gold.dim_customer(cleaned))
        self.gold("dim_product").create(gold.dim_product(cleaned))
        lines = {**cleaned, "crm_sales_details": sized(cleaned["crm_sales_details"])}
        self.gold("fact_sales").create(gold.fact_sales(lines, sized(self.gold("dim_product").read())))
        self._prints(raw, 0)
        self._keep(0)

    def refresh(self, raw: Mapping[str, DataFrame]) -> Touched:
        """Bring the tables to what a full refresh of ``raw`` would make them."""
        touched = Touched()
        version = self._version()
        prints = self._prints(raw, version + 1)
        before = {t: self.spark.read.parquet(self._prints_path(t, version)) for t in silver.TABLES}
        changed = self._pending(version, {t: key_changes(before[t], prints[t]).select("key") for t in silver.TABLES})
        # What gold depends on, as it was: groups that lose a row must be found by their old rows.
        old = {t: self.silver(t).read() for t in silver.TABLES}
        affected = self._pending(version, self._affected(old, changed))
        for table, clean in silver.TABLES.items():
            # Written, as cleaning may read them more than once and joins them.
            rows = written(_of_keys(raw[table].withColumn("_group", raw_group(table)), "_group", changed[table]).drop("_group"))
            self._replace(touched, self.silver(table), changed[table], clean(sized(rows)), table)

        now = gold.stored({t: self.silver(t).read() for t in silver.TABLES})
        again = self._affected(now, changed)
        keys = written_all({t: affected[t].unionByName(again[t]).distinct() for t in again})
        keys = {t: sized(df) for t, df in keys.items()}
        customers = {**now, "crm_cust_info": _of_keys(now["crm_cust_info"], "cst_id", keys["dim_customer"])}
        self._replace(touched, self.gold("dim_customer"), keys["dim_customer"], gold.dim_customer(customers), "dim_customer")
        products = {**now, "crm_prd_info": _of_keys(now["crm_prd_info"], "prd_id", keys["dim_product"])}
        self._replace(touched, self.gold("dim_product"), keys["dim_product"], gold.dim_product(products), "dim_product")
        lines = {**now, "crm_sales_details": _of_keys(now["crm_sales_details"], "sls_ord_num", keys["fact_sales"])}
        facts = gold.fact_sales(lines, sized(self.gold("dim_product").read()))
        self._replace(touched, self.gold("fact_sales"), keys["fact_sales"], facts, "fact_sales")
        self._keep(version + 1)
        return touched

    def _replace(self, touched: Touched, table: BucketTable, keys: DataFrame, rows: DataFrame, name: str) -> None:
        touched.buckets[name] = table.replace(keys, rows)
        touched.keys[name] = keys.count()

    def _pending(self, version: int, keys: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
        """Note the keys a run is about to rewrite; with those of runs from the same version that died on the way."""
        out = {}
        for table, df in keys.items():
            path = f"{self.root}/pending/version={version}/{table}"
            df.write.mode("append").parquet(path)
            out[table] = sized(self.spark.read.schema(df.schema).parquet(path)).distinct()
        return out

    def _affected(self, cleaned: Mapping[str, DataFrame], changed: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
        """Keys of the gold tables that depend on a changed group, by the silver rows given."""
        people = changed["crm_cust_info"].select("key")
        for table in ("erp_cust_az12", "erp_loc_a101"):
            people = people.unionByName(changed[table].select("key"))
        people = sized(people.distinct())
        categories = _of_keys(cleaned["crm_prd_info"], "cat_id", changed["erp_px_cat_g1v2"])
        products = _of_keys(cleaned["crm_prd_info"], GROUPS["crm_prd_info"][0](), changed["crm_prd_info"])
        lines = cleaned["crm_sales_details"]
        # Written, so that Spark knows how few they are before it decides to shuffle all lines to meet them.
        versions = sized(written(products.select(F.col("prd_key").alias("key")).distinct()))
        return {
            "dim_customer": _of_keys(cleaned["crm_cust_info"], "cst_key", people).select(F.col("cst_id").alias("key")).distinct(),
            "dim_product": products.unionByName(categories).select(F.col("prd_id").alias("key")).distinct(),
            "fact_sales": changed["crm_sales_details"].select("key")
            .unionByName(_of_keys(lines, "sls_prd_key", versions).select(F.col("sls_ord_num").alias("key")))
            .distinct(),
        }


def _of_keys(df: DataFrame, column: str | Column, keys: DataFrame) -> DataFrame:
    """The rows whose ``column`` is among the keys, NULL being one."""
    column = F.col(column) if isinstance(column, str) else column
    return df.join(keys.select(F.col("key").alias("_wanted")), column.eqNullSafe(F.col("_wanted")), "left_semi")
