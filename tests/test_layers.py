"""Silver and gold tables on hand-made edge rows."""

import datetime
from decimal import Decimal

import pytest

from oreflow.plans import gold, silver
from oreflow.schemas import BRONZE, GOLD, SILVER

D = datetime.date.fromisoformat


def raw_rows(spark, table, data):
    return spark.createDataFrame(data, BRONZE.tables[table])


AMOUNTS = [
    # sales, quantity, price -> sales, price, incomplete
    (None, "2", "10", "20.00", "10.00", "N"), ("20", "2", None, "20.00", "10.00", "N"),
    (None, "2", None, None, None, "Y"), ("-20", "2", "10", "-20.00", "10.00", "N"),
    ("5", "2", "10", "20.00", "10.00", "N"), ("-5", "2", "10", "-20.00", "10.00", "N"),
    ("20", None, "10", "20.00", "10.00", "N"), (None, None, "10", None, "10.00", "N"),
    ("20", "0", None, "20.00", None, "N"), ("10", "3", None, "9.99", "3.33", "N"),
    ("-10", "3", None, "-9.99", "3.33", "N"), ("20", "2", "-10", "20.00", "10.00", "N"),
]


def test_sales_amounts(spark):
    data = [
        (f"SO{i}", "P", "1", "20240101", "20240102", "20240103", s, q, (p or "") + "\r")
        for i, (s, q, p, *_) in enumerate(AMOUNTS)
    ]
    got = {r["sls_ord_num"]: r for r in silver.sales(raw_rows(spark, "crm_sales_details", data)).collect()}
    money = lambda t: t and Decimal(t)
    for i, (_, _, _, sales, price, incomplete) in enumerate(AMOUNTS):
        r = got[i]
        assert (r["sls_sales"], r["sls_price"], r["sls_incomplete_financial_data"]) == (money(sales), money(price), incomplete), i


def test_sales_keys_and_dates(spark):
    data = [
        ("SO1", " P1 ", "7", "20101229", "0", "20241340", "1", "1", "1\r"),
        ("x2", "P", "7", "0", "0", "0", "1", "1", "1\r"),
        (" 3", " ", "7", "0", "0", "0", "1", "1", "1\r"),
        (None, "P", "7", "0", "0", "0", "1", "1", "1\r"),
        ("", "P", "7", "0", "0", "0", "1", "1", "1\r"),
        ("SO4", "ABCDEFGHIJKLMNOP", "x", "5489", "20240229", "20230229", "1", "1", "1\r"),
    ]
    got = silver.sales(raw_rows(spark, "crm_sales_details", data))
    assert got.schema.names == SILVER.tables["crm_sales_details"].names
    out = {r["sls_ord_num"]: r for r in got.collect()}
    assert set(out) == {1, 4}
    assert (out[1]["sls_prd_key"], out[1]["sls_order_dt"], out[1]["sls_ship_dt"]) == ("P1", D("2010-12-29"), None)
    assert (out[4]["sls_prd_key"], out[4]["sls_cust_id"], out[4]["sls_ship_dt"]) == ("ABCDEFGHIJKL", None, D("2024-02-29"))


def test_an_amount_that_does_not_fit_raises(spark):
    data = [("SO1", "P", "7", "0", "0", "0", None, "2000000", "99999999.99\r")]
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        silver.sales(raw_rows(spark, "crm_sales_details", data)).collect()


def test_products(spark):
    data = [
        (" 1", "CO-PE-PD-M282", " Pedal ", "-5.5", "m ", "2020-01-01", "2019-01-01\r"),
        ("2", "CO-PE-PD-M282", "Pedal", None, "Q", "2021-01-01", "\r"),
        ("", "CO-PE-PD-M282", "no id", "1", None, "2020-06-01", "\r"),
    ]
    got = silver.products(raw_rows(spark, "crm_prd_info", data)).orderBy("prd_id").collect()
    assert [tuple(r) for r in got] == [
        (1, "CO_PD", "PD-M282", "Pedal", Decimal("5.50"), "Mountain", D("2020-01-01"), D("2020-12-31")),
        (2, "CO_PD", "PD-M282", "Pedal", None, "Other", D("2021-01-01"), None),
    ]


def test_customers(spark):
    data = [
        ("1 ", "AW00011000", " mARY-ann", "de la cruz", "m", "F", "2025-10-06\r"),
        ("2", "AW00011001", None, "B", "x", None, "bad\r"),
        (None, "AW00011002", "A", "B", "S", "M", "2025-10-06\r"),
    ]
    got = silver.customers(raw_rows(spark, "crm_cust_info", data)).orderBy("cst_id").collect()
    assert [tuple(r) for r in got] == [
        (1, "AW00011000", "Mary-ann", "De la cruz", "Married", "Female", D("2025-10-06")),
        (2, "AW00011001", None, "B", "Other", None, None),
    ]


def test_erp_tables(spark):
    people = [("NASAW00011000", "1985-13-45", "Female \r"), ("11000", "1980-01-01", "M\r"), (" ", None, None)]
    got = silver.erp_customers(raw_rows(spark, "erp_cust_az12", people)).collect()
    assert [tuple(r) for r in got] == [("AW00011000", None, "Female")]
    places = [("AW-00011000", "DE\r"), (None, "US\r"), ("AW-1", "\r")]
    got = silver.erp_locations(raw_rows(spark, "erp_loc_a101", places)).collect()
    assert [tuple(r) for r in got] == [("AW00011000", "Germany"), ("AW1", None)]
    kinds = [("AC_HE", " Accessories", "Bottles and Cages", "yes\r"), ("", "x", "y", "No\r"), ("B", "c", None, "?\r")]
    got = silver.erp_categories(raw_rows(spark, "erp_px_cat_g1v2", kinds)).collect()
    assert [tuple(r) for r in got] == [("AC_HE", "Accessories", "Bottles and Cages", "Yes"), ("B", "c", None, None)]


# order, key, order date, ship, delivery -> product, order date, lifecycle, sequence
FACTS = [
    (1, "P", "2020-06-01", "2020-06-02", "2020-06-03", 1, "2020-06-01", "N", "N"),
    (2, "P", "2020-12-31", "2021-01-02", "2021-01-02", 1, "2020-12-31", "N", "N"),
    (3, "P", "2019-01-01", "2019-01-02", "2019-01-03", None, "2019-01-01", "Y", "N"),
    (4, "P", None, "2021-04-01", "2021-05-03", None, "2021-05-01", "Y", "Y"),
    (4, "Q", "2021-05-01", "2021-05-02", "2021-05-03", None, "2021-05-01", "Y", "N"),
    (5, "P", None, "2021-05-02", "2021-05-03", None, None, "Y", "N"),
    (6, "P", "2021-02-01", "2021-01-15", "2021-03-01", 2, "2021-02-01", "N", "Y"),
    (7, "P", "2021-02-01", None, "2021-01-01", 2, "2021-02-01", "N", "N"),
]


def test_fact_flags(spark):
    date = lambda t: t and D(t)
    lines = spark.createDataFrame(
        [(o, k, 1, date(a), date(b), date(c), Decimal("-5.00"), 1, Decimal("5.00"), "N") for o, k, a, b, c, *_ in FACTS],
        SILVER.tables["crm_sales_details"],
    )
    version = lambda i, s, e: (i, "P", "p", None, None, None, None, None, D(s), date(e))
    products = spark.createDataFrame(
        [version(1, "2020-01-01", "2020-12-31"), version(2, "2021-01-01", None)], GOLD.tables["dim_product"]
    )
    out = gold.fact_sales({"crm_sales_details": lines}, products)
    assert out.schema.names == GOLD.tables["fact_sales"].names
    got = {
        (r["order_number"], r["product_key"]): (
            r["product_id"], r["order_date"], r["err_date_lifecycle"], r["err_date_sequence"]
        )
        for r in out.collect()
    }
    assert got == {(f[0], f[1]): (f[5], date(f[6]), f[7], f[8]) for f in FACTS}
    assert {r["sales"] for r in out.collect()} == {Decimal("5.00")}


def test_dim_customer_keeps_every_customer(spark):
    silver_tables = {
        "crm_cust_info": spark.createDataFrame(
            [(1, "A", "F", "L", None, None, None), (2, "B", None, None, None, "Male", None),
             (3, None, None, None, None, "Female", None)], SILVER.tables["crm_cust_info"]),
        "erp_cust_az12": spark.createDataFrame(
            [("A", D("1980-01-01"), "Female"), ("B", None, "Female"), (None, None, "Male")], SILVER.tables["erp_cust_az12"]),
        "erp_loc_a101": spark.createDataFrame([("A", "France"), (None, "Canada")], SILVER.tables["erp_loc_a101"]),
    }
    got = gold.dim_customer(silver_tables).orderBy("customer_id").collect()
    assert [(r["customer_id"], r["gender"], r["birth_date"], r["country_of_residence"]) for r in got] == [
        (1, "Female", D("1980-01-01"), "France"), (2, None, None, None), (3, "Female", None, None),
    ]
