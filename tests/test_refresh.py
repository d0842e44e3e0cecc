"""The whole refresh from files, its gates and its reruns."""

import pytest
from pyspark.sql import functions as F

from oreflow import session
from oreflow.operators.checks import ValidationFailed
from oreflow.plans import gold
from oreflow.plans.refresh import LoadFailed, Refresh, refresh_all
from oreflow.schemas import BRONZE, GOLD, SILVER
from oreflow.sources.tables import Warehouse

FILES = {
    "crm/cust_info": "cst_id,cst_key,cst_firstname,cst_lastname,cst_marital_status,cst_gndr,cst_create_date\n"
    "1,AW00000001, ann,LEE ,M,F,2025-10-06\n2,AW00000002,bob,,S,,2025-10-07\n2,AW00000002,bob,Ray,S,,2025-10-06\n",
    "crm/prd_info": "prd_id,prd_key,prd_nm,prd_cost,prd_line,prd_start_dt,prd_end_dt\n"
    "1,CO-PE-P1,Pedal,-2,M,2020-01-01,2019-01-01\n2,CO-PE-P1,Pedal,3,M,2021-01-01,\n",
    "crm/sales_details": "sls_ord_num,sls_prd_key,sls_cust_id,sls_order_dt,sls_ship_dt,sls_due_dt,sls_sales,sls_quantity,sls_price\n"
    "SO10,P1,1,20200601,20200602,20200603,20,2,10\nSO11,P1,2,0,20210602,20210603,,2,10\n",
    "erp/CUST_AZ12": "CID,BDATE,GEN\nNASAW00000001,1980-01-01,Female\nAW00000002,1985-13-45,Male\n",
    "erp/LOC_A101": "CID,CNTRY\nAW-00000001,DE\nAW-00000002,USA\n",
    "erp/PX_CAT_G1V2": "ID,CAT,SUBCAT,MAINTENANCE\nCO_PD,Components,Pedals,No\n",
}


def put_sources(root, **changed):
    for name, body in {**FILES, **changed}.items():
        folder, stem = name.split("/")
        (root / f"source_{folder}").mkdir(parents=True, exist_ok=True)
        (root / f"source_{folder}" / f"{stem}.csv").write_bytes(body.replace("\n", "\r\n").encode())
    return str(root)


@pytest.fixture
def warehouse(spark, tmp_path):
    yield Warehouse(spark, str(tmp_path / "wh"))
    for layer in ("bronze", "silver", "gold", "admin"):
        spark.sql(f"DROP DATABASE IF EXISTS {layer} CASCADE")


def test_refresh_publishes_and_can_be_repeated(spark, tmp_path, warehouse):
    source = put_sources(tmp_path / "in")
    run_id, rates = refresh_all(warehouse, source)
    assert rates == {"is_incomplete_financial_data": 0.0, "err_date_lifecycle": 0.5, "err_date_sequence": 0.0}
    facts = spark.table("gold.fact_sales").orderBy("order_number").collect()
    assert [(r["order_number"], r["product_id"], r["customer_id"], float(r["sales"])) for r in facts] == [
        (10, 1, 1, 20.0), (11, None, 2, 20.0)
    ]
    people = spark.table("gold.dim_customer").orderBy("customer_id").collect()
    assert [tuple(r)[:5] for r in people] == [
        (1, "Ann", "Lee", "Married", "Female"), (2, "Bob", "Ray", "Single", "Male")
    ]
    state = {r["step"]: r for r in Refresh(warehouse, run_id).state().collect()}
    assert len(state) == 15 and {r["validation_status"] for r in state.values()} == {"SUCCESS"}
    assert (state["silver.load_crm_cust_info"]["rows_read"], state["silver.load_crm_cust_info"]["rows_written"]) == (3, 2)
    assert state["bronze.load_crm_cust_info"]["rows_read"] == 3
    assert Refresh.resume(warehouse, "gold").run_id == run_id
    assert warehouse.listed("gold") == sorted(GOLD.tables)

    again, _ = refresh_all(warehouse, source)
    assert again != run_id
    assert spark.table("gold.fact_sales").orderBy("order_number").collect() == facts
    # The run before stays readable; a third one takes its place, and the first goes.
    assert (warehouse.current(GOLD).run_id, warehouse.current(GOLD).previous) == (again, run_id)
    third, _ = refresh_all(warehouse, source)
    kept = {p.name for p in (tmp_path / "wh" / "gold" / "fact_sales").iterdir()}
    assert kept == {f"run_id={r}" for r in (again, third)}
    assert spark.table("gold.fact_sales").orderBy("order_number").collect() == facts


def test_tables_of_a_layer_change_over_together(spark, warehouse):
    def load(run_id, n):
        for name, schema in SILVER.tables.items():
            nulls = spark.range(n).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])
            warehouse.write(SILVER, name, nulls, run_id)

    def seen():
        return {spark.table(f"silver.{t}").count() for t in SILVER.tables}

    load("run-1", 1)
    warehouse.publish(SILVER, "run-1")
    assert seen() == {1}
    load("run-2", 2)
    warehouse.create_if_absent(SILVER)  # replaces the views, not the pointer
    assert seen() == {1}
    warehouse.publish(SILVER, "run-2")
    assert seen() == {2}
    plan = spark.table("silver.crm_cust_info")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_id" in plan and "PartitionCount" not in plan


def test_scratch_can_be_cleared(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_folder", lambda spark: str(tmp_path))
    assert session.written(spark.range(3)).count() == 3
    assert len(list(tmp_path.iterdir())) == 1
    session.clear_scratch(spark)
    assert not list(tmp_path.iterdir())
    assert session.written(spark.range(3)).count() == 3


def test_a_failing_check_stops_before_gold_and_leaves_the_published_tables(spark, tmp_path, warehouse):
    refresh_all(warehouse, put_sources(tmp_path / "in"))
    before = spark.table("silver.crm_sales_details").count()
    more = FILES["crm/sales_details"] + "SO12,P9,3,20200601,20200602,20200603,20,2,10\n"
    with pytest.raises(ValidationFailed) as caught:
        refresh_all(warehouse, put_sources(tmp_path / "in2", **{"crm/sales_details": more}))
    assert {f["columns"] for f in caught.value.failed} == {
        "crm_sales_details.sls_cust_id->crm_cust_info.cst_id", "crm_sales_details.sls_prd_key->crm_prd_info.prd_key"
    }
    assert spark.table("silver.crm_sales_details").count() == before
    with pytest.raises(LoadFailed):
        Refresh.resume(warehouse, "gold")
    newest = Refresh.resume(warehouse, "silver")
    state = {r["step"]: r for r in newest.state().where(f"run_id = '{newest.run_id}'").collect()}
    assert state["silver.load_crm_prd_info"]["referential_integrity"] == "FAIL"
    assert state["silver.load_erp_loc_a101"]["validation_status"] == "SUCCESS"
    assert not any(step.startswith("gold") for step in state)


def test_missing_and_malformed_sources(spark, tmp_path, warehouse):
    source = put_sources(tmp_path / "in", **{"erp/LOC_A101": FILES["erp/LOC_A101"] + "\n"})
    with pytest.raises(ValidationFailed) as caught:
        refresh_all(warehouse, source)
    assert [(f["check"], f["table"], f["columns"]) for f in caught.value.failed] == [
        ("COUNT_MISMATCH", "erp_loc_a101", "3 != 2"), ("malformed_lines", "erp_loc_a101", "1")
    ]
    uneven = FILES["erp/LOC_A101"] + "AW-00000003,DE,surplus\nAW-00000004\n"
    with pytest.raises(ValidationFailed) as caught:
        refresh_all(warehouse, put_sources(tmp_path / "uneven", **{"erp/LOC_A101": uneven}))
    assert [(f["check"], f["table"], f["columns"]) for f in caught.value.failed] == [("malformed_lines", "erp_loc_a101", "2")]
    (tmp_path / "few" / "source_crm").mkdir(parents=True)
    (tmp_path / "few" / "source_crm" / "cust_info.csv").write_text(FILES["crm/cust_info"])
    with pytest.raises(LoadFailed, match="crm_prd_info"):
        refresh_all(warehouse, str(tmp_path / "few"))


def test_a_failing_step_is_logged_with_its_class(spark, tmp_path, warehouse):
    huge = FILES["crm/sales_details"].replace("SO11,P1,2,0,20210602,20210603,,2,10", "SO11,P1,2,0,0,0,,2000000,99999999")
    run = Refresh.start(warehouse)
    run.load_bronze(put_sources(tmp_path / "in", **{"crm/sales_details": huge}))
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        run.load_silver()
    step = run.state().where("step = 'silver.load_crm_sales_details'").first()
    assert (step["status"], step["error_class"]) == ("FAILED", "DATA QUALITY")
    assert step["error_message"].startswith("Step failed: silver.load_crm_sales_details | ")


def test_absent_tables_are_created_empty_once(spark, warehouse):
    warehouse.create_if_absent(SILVER)
    warehouse.create_if_absent(SILVER)
    assert warehouse.listed("silver") == sorted(SILVER.tables)
    assert spark.table("silver.crm_prd_info").isEmpty()
    assert spark.table("silver.crm_prd_info").dtypes == [(f.name, f.dataType.simpleString()) for f in SILVER.tables["crm_prd_info"]]


def test_contract_covers_every_table():
    assert set(BRONZE.tables) == set(SILVER.tables) == set(SILVER.keys)
    assert set(GOLD.tables) == set(GOLD.keys)
    assert set(gold.FLAGS) <= set(GOLD.tables["fact_sales"].names)
