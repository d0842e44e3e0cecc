"""Bronze to silver: one function per table, raw text in, typed and conformed rows out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.functions import codes, text, values
from oreflow.operators.survivors import survivors
from oreflow.operators.versions import chain_end_dates
from oreflow.schemas import SILVER, declared_widths
from oreflow.sources.tables import conform


def _clip_to(schema):
    """A function giving a text column cut to the width the schema declares for ``name``."""
    widths = declared_widths(schema)
    return lambda c, name: text.clip(c, widths[name]).alias(name)


def clean_customers(raw: DataFrame) -> DataFrame:
    """Typed customer records, copies of a key still included."""
    fit = _clip_to(SILVER.tables["crm_cust_info"])
    return raw.select(
        values.to_int(text.clean(F.col("cst_id"))).alias("cst_id"),
        fit(text.clean(F.col("cst_key")), "cst_key"),
        fit(text.sentence_case(text.clean(F.col("cst_firstname"))), "cst_firstname"),
        fit(text.sentence_case(text.clean(F.col("cst_lastname"))), "cst_lastname"),
        fit(
            codes.label_or_other(text.clean(F.col("cst_marital_status")), codes.MARITAL_STATUS),
            "cst_marital_status",
        ),
        fit(codes.label_or_other(text.clean(F.col("cst_gndr")), codes.GENDER), "cst_gndr"),
        values.to_date(text.clean_last_field(F.col("cst_create_date"))).alias("cst_create_date"),
    )


def customers(raw: DataFrame) -> DataFrame:
    kept = survivors(
        clean_customers(raw),
        key="cst_key",
        record_id="cst_id",
        date="cst_create_date",
        described_by=["cst_firstname", "cst_lastname", "cst_marital_status", "cst_gndr"],
    )
    return conform(kept, SILVER.tables["crm_cust_info"])


def products(raw: DataFrame) -> DataFrame:
    """Product versions, chained per full key (category prefix included), ordered by id."""
    fit = _clip_to(SILVER.tables["crm_prd_info"])
    full_key = text.clean(F.col("prd_key"))
    typed = raw.select(
        values.to_int(text.clean(F.col("prd_id"))).alias("prd_id"),
        text.clip(full_key, 18).alias("full_key"),
        fit(codes.category_of(full_key), "cat_id"),
        fit(text.tail(full_key, 7), "prd_key"),
        fit(text.clean(F.col("prd_nm")), "prd_nm"),
        F.abs(values.to_money(text.clean(F.col("prd_cost")))).alias("prd_cost"),
        fit(codes.label_or_other(text.clean(F.col("prd_line")), codes.PRODUCT_LINE), "prd_line"),
        values.to_date(text.clean(F.col("prd_start_dt"))).alias("prd_start_dt"),
        values.to_date(text.clean_last_field(F.col("prd_end_dt"))).alias("prd_end_dt"),
    )
    chained = chain_end_dates(typed, "full_key", "prd_id", "prd_start_dt", "prd_end_dt")
    return conform(chained, SILVER.tables["crm_prd_info"])


def sales(raw: DataFrame) -> DataFrame:
    """Order lines with reconciled amounts; lines without a usable (order, product) key are left out."""
    fit = _clip_to(SILVER.tables["crm_sales_details"])
    given = raw.select(
        values.to_int(text.without_prefix(F.trim("sls_ord_num"), "SO")).alias("sls_ord_num"),
        fit(text.clean(F.col("sls_prd_key")), "sls_prd_key"),
        values.to_int(F.trim("sls_cust_id")).alias("sls_cust_id"),
        *[values.compact_date(F.trim(c)).alias(c) for c in ("sls_order_dt", "sls_ship_dt", "sls_due_dt")],
        values.to_money(F.trim("sls_sales")).alias("sls_sales"),
        values.to_int(F.trim("sls_quantity")).alias("sls_quantity"),
        F.abs(values.to_money(text.clean_last_field(F.col("sls_price")))).alias("sls_price"),
    ).dropna(subset=["sls_ord_num", "sls_prd_key"])
    amounts = [F.col(c) for c in ("sls_sales", "sls_quantity", "sls_price")]
    filled = given.withColumns(
        {"sls_sales": values.fill_sales(*amounts), "sls_price": values.fill_price(*amounts)}
    )
    reconciled = filled.withColumns(
        {
            "sls_sales": values.reconcile_sales(*amounts),
            "sls_incomplete_financial_data": values.flag(
                F.col("sls_sales").isNull() & F.col("sls_price").isNull()
            ),
        }
    )
    return conform(reconciled, SILVER.tables["crm_sales_details"])


def erp_customers(raw: DataFrame) -> DataFrame:
    fit = _clip_to(SILVER.tables["erp_cust_az12"])
    typed = raw.select(
        fit(text.from_first(text.clean(F.col("cid")), "AW"), "cid"),
        values.to_date(text.clean(F.col("bdate"))).alias("bdate"),
        fit(codes.label_or_other(text.clean_last_field(F.col("gen")), codes.GENDER), "gen"),
    ).where(F.col("cid").isNotNull())
    return conform(typed, SILVER.tables["erp_cust_az12"])


def erp_locations(raw: DataFrame) -> DataFrame:
    fit = _clip_to(SILVER.tables["erp_loc_a101"])
    typed = raw.select(
        fit(F.replace(text.clean(F.col("cid")), F.lit("-"), F.lit("")), "cid"),
        fit(codes.label_or_other(text.clean_last_field(F.col("cntry")), codes.COUNTRY), "cntry"),
    ).where(F.col("cid").isNotNull())
    return conform(typed, SILVER.tables["erp_loc_a101"])


def erp_categories(raw: DataFrame) -> DataFrame:
    fit = _clip_to(SILVER.tables["erp_px_cat_g1v2"])
    typed = raw.select(
        *[fit(text.clean(F.col(c)), c) for c in ("id", "cat", "subcat")],
        fit(codes.label_or_null(text.clean_last_field(F.col("maintenance")), codes.YES_NO), "maintenance"),
    ).where(F.col("id").isNotNull())
    return conform(typed, SILVER.tables["erp_px_cat_g1v2"])


# Bronze and silver share table names; order is dimensions before the sales lines.
TABLES = {
    "erp_cust_az12": erp_customers,
    "erp_loc_a101": erp_locations,
    "erp_px_cat_g1v2": erp_categories,
    "crm_cust_info": customers,
    "crm_prd_info": products,
    "crm_sales_details": sales,
}
