"""Silver to gold: two dimensions and the sales fact."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.functions import codes, values
from oreflow.operators.fill import fill_from_siblings
from oreflow.operators.versions import version_join
from oreflow.schemas import GOLD
from oreflow.session import sized
from oreflow.sources.tables import conform

# Tables in which the dimensions look rows up.
LOOKED_UP = ("erp_cust_az12", "erp_loc_a101", "erp_px_cat_g1v2")

FLAGS = ["is_incomplete_financial_data", "err_date_lifecycle", "err_date_sequence"]


def stored(silver: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Silver tables read from files, those that are looked up as sides of joins by the size of their rows."""
    return {**silver, **{table: sized(silver[table]) for table in LOOKED_UP}}


def dim_customer(silver: Mapping[str, DataFrame]) -> DataFrame:
    """Customers with birth date and country from the ERP.  Both joins share one shuffle on the key."""
    crm = silver["crm_cust_info"]
    born = silver["erp_cust_az12"].withColumnRenamed("cid", "born_cid")
    lives = silver["erp_loc_a101"].withColumnRenamed("cid", "lives_cid")
    joined = crm.join(born, F.col("cst_key") == F.col("born_cid"), "left").join(
        lives, F.col("cst_key") == F.col("lives_cid"), "left"
    )
    customer = joined.select(
        F.col("cst_id").alias("customer_id"),
        F.col("cst_firstname").alias("first_name"),
        F.col("cst_lastname").alias("last_name"),
        F.col("cst_marital_status").alias("marital_status"),
        codes.merge_gender(F.col("cst_gndr"), F.col("gen")).alias("gender"),
        F.col("cst_create_date").alias("created_date"),
        F.col("bdate").alias("birth_date"),
        F.col("cntry").alias("country_of_residence"),
    )
    return conform(customer, GOLD.tables["dim_customer"])


def dim_product(silver: Mapping[str, DataFrame]) -> DataFrame:
    """Product versions with their category; an unknown category leaves its columns NULL."""
    joined = silver["crm_prd_info"].join(
        silver["erp_px_cat_g1v2"], F.col("cat_id") == F.col("id"), "left"
    )
    product = joined.select(
        F.col("prd_id").alias("product_id"),
        F.col("prd_key").alias("product_key"),
        F.col("prd_nm").alias("product_name"),
        F.col("cat").alias("category"),
        F.col("prd_line").alias("product_line"),
        F.col("subcat").alias("subcategory"),
        F.col("maintenance").alias("maintenance_required"),
        F.col("prd_cost").alias("cost"),
        F.col("prd_start_dt").alias("start_date"),
        F.col("prd_end_dt").alias("end_date"),
    )
    return conform(product, GOLD.tables["dim_product"])


def fact_sales(silver: Mapping[str, DataFrame], products: DataFrame) -> DataFrame:
    """Order lines with the product version valid on their own order date, and quality flags.

    The version is looked up with the date the line came with; a date lent by a sibling line
    only shows up as ``order_date`` and in the sequence flag.  The lending runs first because
    it needs nothing from the product side and so works on the narrower rows.
    """
    lines = fill_from_siblings(silver["crm_sales_details"], "sls_ord_num", "sls_order_dt", into="order_date")
    versioned = version_join(
        lines, products, "sls_prd_key", "sls_order_dt", "product_key", "start_date", "end_date", ["product_id"]
    )
    ordered, shipped, delivered = (F.col(c) for c in ("order_date", "sls_ship_dt", "sls_due_dt"))
    fact = versioned.select(
        F.col("sls_ord_num").alias("order_number"),
        "product_id",
        F.col("sls_prd_key").alias("product_key"),
        F.col("sls_cust_id").alias("customer_id"),
        "order_date",
        shipped.alias("ship_date"),
        delivered.alias("delivery_date"),
        F.abs("sls_sales").alias("sales"),
        F.col("sls_quantity").alias("quantity"),
        F.col("sls_price").alias("price"),
        F.col("sls_incomplete_financial_data").alias("is_incomplete_financial_data"),
        values.flag(F.col("product_id").isNull()).alias("err_date_lifecycle"),
        values.flag((shipped < ordered) | (delivered < shipped)).alias("err_date_sequence"),
    )
    return conform(fact, GOLD.tables["fact_sales"])
