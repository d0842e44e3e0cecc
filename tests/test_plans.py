"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from oreflow.operators.checks import orphan_rows
from oreflow.operators.fill import fill_from_siblings
from oreflow.operators.profile import profile
from oreflow.operators.survivors import survivors
from oreflow.operators.versions import chain_end_dates, version_join
from oreflow.plans import gold, silver
from oreflow.plans.incremental import Incremental
from oreflow.plans.refresh import Refresh
from oreflow.schemas import GOLD, SILVER, Reference
from oreflow.session import sized, written
from oreflow.sources.tables import Warehouse
from oreflow.workload.queries import QUERIES, written_silver

SF = "/root/testdata/sf0.001"


def planned(df):
    """The plan before adaptive changes."""
    return df._jdf.queryExecution().executedPlan().toString()


def executed(df):
    """The plan as it was run."""
    df.collect()
    return planned(df).split("== Initial Plan ==")[0]


def orders(spark):
    return spark.read.parquet(f"{SF}/orders.parquet").withColumn("day", F.col("o_orderdate").cast("date"))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_products(spark, name):
    if name.startswith("refresh_"):
        pytest.skip("reads tables that a whole refresh wrote; its plans are covered by the others")
    plan = planned(QUERIES[name](spark, SF))
    for node in ("Python", "Pandas", "ArrowEval", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


def test_group_statistics_read_twice_and_need_no_window(spark):
    plan = planned(survivors(orders(spark), "o_custkey", "o_orderkey", "day", ["o_orderstatus", "o_orderpriority"]))
    assert len(re.findall(r"\bFileScan ", plan)) <= 2 and "Window" not in plan


def test_product_versions_are_scanned_few_times(spark):
    plan = planned(QUERIES["silver_prd_info"](spark, SF))
    assert len(re.findall(r"\bFileScan ", plan)) <= 12


def test_scans_read_only_what_is_needed(spark):
    filled = fill_from_siblings(orders(spark), "o_custkey", "day", "filled").select("o_orderkey", "filled")
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", planned(filled))
    assert scans and all("o_totalprice" not in s and "o_orderpriority" not in s for s in scans)
    # The statistics read the key and the date only.
    assert any("o_orderkey" not in s for s in scans)


def test_filters_reach_the_scan(spark):
    kept = orders(spark).where("o_orderkey > 100")
    plan = planned(fill_from_siblings(kept, "o_custkey", "day", "filled"))
    assert "GreaterThan(o_orderkey,100)" in plan


def test_profile_reads_once_and_limits_before_the_shuffle(spark):
    plan = executed(profile(orders(spark).select("o_orderkey", "o_orderstatus", "o_orderpriority"), "orders"))
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan
    assert re.search(r"WindowGroupLimit .*Partial", plan)


def test_a_version_join_reads_its_facts_once(spark):
    plan = planned(QUERIES["version_join_overlapping"](spark, SF))
    assert len(re.findall(r"\bFileScan [^\n]*event_type#", plan)) == 1
    assert "Subquery" not in plan


def test_small_dimension_is_broadcast_and_facts_are_shuffled_once(spark):
    tables = written_silver(spark, SF)
    plan = executed(gold.fact_sales(tables, gold.dim_product(tables)))
    assert "BroadcastHashJoin" in plan
    # One exchange of the statistics, and one of the rows where they do not meet them by broadcast.
    assert len(re.findall(r"\bExchange hashpartitioning\(.*sls_ord_num#\d+", plan)) <= 2
    assert "sls_sales" not in str(re.findall(r"keys=\[sls_ord_num.*", plan))


@pytest.fixture
def large_tables(spark):
    """Make AQE treat these small tables as it would large ones."""
    changes = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in changes}
    for k, v in changes.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def hot(spark, n=60000):
    """A third of the rows have one key."""
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise((F.col("id") % 5000).cast("int"))
    return spark.range(0, n, 1, 8).select("id", key.alias("key"), F.date_add(F.lit("2024-05-05").cast("date"), (F.col("id") % 9).cast("int")).alias("day"))


def test_hot_key_of_a_version_join_is_split(spark, large_tables):
    versions = spark.range(0, 5000).select(
        F.col("id").cast("int").alias("vkey"), F.lit("2024-01-01").cast("date").alias("since"),
        F.lit(None).cast("date").alias("until"), F.col("id").alias("vid"),
    )
    out = version_join(hot(spark), versions, "key", "day", "vkey", "since", "until", ["vid"])
    plan = executed(out)
    assert "SortMergeJoin(skew=true)" in plan
    assert out.where("vid IS NULL").isEmpty() and out.count() == 60000


def test_hot_key_of_an_orphan_listing_is_split(spark, large_tables):
    known = spark.range(1000, 5000).select(F.col("id").cast("int").alias("k"))
    out = orphan_rows(hot(spark), known, Reference("a", "key", "b", "k"))
    assert "SortMergeJoin(skew=true)" in executed(out)
    assert out.where("key = 7").count() == 20008 and out.where("key >= 1000").isEmpty()


def test_hot_customer_key_is_split_across_both_joins(spark, large_tables):
    text = lambda c: F.concat(F.lit("AW"), F.col(c).cast("string"))
    people = spark.range(0, 5000)
    silver = {
        "crm_cust_info": hot(spark).select(
            F.col("id").cast("int").alias("cst_id"), text("key").alias("cst_key"), F.lit("A").alias("cst_firstname"),
            F.lit("B").alias("cst_lastname"), F.lit("Single").alias("cst_marital_status"),
            F.lit("Male").alias("cst_gndr"), F.col("day").alias("cst_create_date"),
        ),
        "erp_cust_az12": people.select(text("id").alias("cid"), F.lit(None).cast("date").alias("bdate"), F.lit("Male").alias("gen")),
        "erp_loc_a101": people.select(text("id").alias("cid"), F.lit("France").alias("cntry")),
    }
    out = gold.dim_customer(silver)
    assert "SortMergeJoin(skew=true)" in executed(out)
    assert out.where("country_of_residence = 'France'").count() == 60000


def test_a_hot_group_is_split(spark, large_tables):
    out = fill_from_siblings(hot(spark), "key", "day", "filled")
    assert "SortMergeJoin(skew=true)" in executed(out)
    assert out.where("filled IS NULL").isEmpty()


@pytest.fixture
def low_limit(spark):
    """A limit for broadcasts that files of some 10,000 rows keep and their rows exceed."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "400KB")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_side_is_broadcast_by_its_rows_not_by_its_files(spark, low_limit):
    facts = spark.range(1_000_000)
    few_values = spark.range(20_000).select((F.col("id") % 3).alias("id"), F.lit("x").alias("v"))
    stored = written(few_values)
    assert "BroadcastHashJoin" in planned(facts.join(stored, "id"))
    assert "SortMergeJoin" in planned(facts.join(sized(stored).where("id < 9").withColumnRenamed("v", "w"), "id"))
    assert "BroadcastHashJoin" in planned(facts.join(sized(written(few_values.limit(100))), "id"))
    assert "BroadcastHashJoin" in planned(facts.join(sized(written(few_values.limit(0))), "id"))
    rows = facts.join(sized(stored), "id").groupBy("id").count()
    assert sorted(map(tuple, rows.collect())) == [(0, 6667), (1, 6667), (2, 6666)]


def many_people(spark, n=20_000):
    """Raw extracts of ``n`` customers and as many categories, with one product and one order line each."""
    ids = spark.range(n).select(F.col("id").cast("string").alias("n"), F.lpad(F.col("id").cast("string"), 8, "0").alias("k"))
    key, code = F.concat(F.lit("AW"), "k"), F.lpad("n", 5, "0")
    return {
        "crm_cust_info": ids.select(
            F.col("n").alias("cst_id"), key.alias("cst_key"), F.lit("a").alias("cst_firstname"), F.lit("b").alias("cst_lastname"),
            F.lit("M").alias("cst_marital_status"), F.lit("F").alias("cst_gndr"), F.lit("2025-10-01").alias("cst_create_date"),
        ),
        "crm_prd_info": ids.select(
            F.col("n").alias("prd_id"), F.concat(code, F.lit("-P"), "n").alias("prd_key"), F.lit("p").alias("prd_nm"),
            F.lit("2").alias("prd_cost"), F.lit("M").alias("prd_line"), F.lit("2020-01-01").alias("prd_start_dt"), F.lit("").alias("prd_end_dt"),
        ),
        "crm_sales_details": ids.select(
            F.concat(F.lit("SO"), "n").alias("sls_ord_num"), F.concat(F.lit("P"), "n").alias("sls_prd_key"), F.col("n").alias("sls_cust_id"),
            *[F.lit("20210101").alias(c) for c in ("sls_order_dt", "sls_ship_dt", "sls_due_dt")],
            *[F.lit("2").alias(c) for c in ("sls_sales", "sls_quantity", "sls_price")],
        ),
        "erp_cust_az12": ids.select(key.alias("cid"), F.lit("1980-06-15").alias("bdate"), F.lit("F").alias("gen")),
        "erp_loc_a101": ids.select(key.alias("cid"), F.lit("DE").alias("cntry")),
        "erp_px_cat_g1v2": ids.select(code.alias("id"), F.lit("c").alias("cat"), F.lit("s").alias("subcat"), F.lit("No").alias("maintenance")),
    }


@pytest.fixture
def gold_plans(monkeypatch):
    """The plans of the gold tables as a load builds them, in order."""
    plans = []

    def noted(build):
        def built(*given):
            out = build(*given)
            plans.append((build.__name__, planned(out)))
            return out
        return built

    for name in ("dim_customer", "dim_product", "fact_sales"):
        monkeypatch.setattr(gold, name, noted(getattr(gold, name)))
    return plans


def test_changes_do_not_broadcast_large_tables_of_small_files(spark, low_limit, gold_plans, tmp_path):
    raw = {t: written(df) for t, df in many_people(spark).items()}
    tables = Incremental(spark, str(tmp_path / "t"), buckets=2)
    tables.first(raw)
    moved = F.when(F.col("cid") == "AW00000007", "FR").otherwise(F.col("cntry"))
    touched = tables.refresh({**raw, "erp_loc_a101": raw["erp_loc_a101"].withColumn("cntry", moved)})
    assert touched.keys["dim_customer"] == 1
    assert [name for name, _ in gold_plans] == ["dim_customer", "dim_product", "fact_sales"] * 2
    for name, plan in gold_plans[:3]:
        assert "SortMergeJoin" in plan and ("BroadcastExchange" not in plan or name == "fact_sales"), name
    # The tables looked up in are as large as before; the keys that rows are chosen by are few, and still broadcast.
    assert "LeftSemi" in gold_plans[3][1] and gold_plans[3][1].count("BroadcastExchange") == 1
    lives = tables.gold("dim_customer").read().groupBy("country_of_residence").count()
    assert sorted(map(tuple, lives.collect())) == [("France", 1), ("Germany", 19_999)]
    assert tables.gold("fact_sales").read().where("product_id IS NOT NULL").count() == 20_000


def test_a_full_refresh_does_not_broadcast_large_tables_of_small_files(spark, low_limit, gold_plans, tmp_path):
    run = Refresh(Warehouse(spark, str(tmp_path / "wh")), "run-1")
    for name, df in many_people(spark).items():
        run.warehouse.write(SILVER, name, silver.TABLES[name](df), run.run_id)
    run.load_gold()
    for name, plan in gold_plans[:2]:
        assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan, name
    people = run.warehouse.read(GOLD, "dim_customer", run.run_id)
    assert people.where("country_of_residence = 'Germany' AND birth_date IS NOT NULL").count() == 20_000
    assert run.warehouse.read(GOLD, "fact_sales", run.run_id).where("product_id IS NOT NULL").count() == 20_000


def test_a_hot_group_of_rows_without_a_value_is_split(spark, large_tables):
    """Rows with a value meet no join, so it is among the others that a hot group has to be split."""
    lacking = F.when(F.col("key") == 7, F.col("id") % 5 > 0).otherwise(F.col("id") % 7 == 1)
    out = fill_from_siblings(hot(spark).withColumn("day", F.when(~lacking, F.col("day"))), "key", "day", "filled")
    assert "SortMergeJoin(skew=true)" in executed(out)
    assert out.where("day IS NULL").count() > 16_000 and out.where("filled IS NULL").isEmpty()
