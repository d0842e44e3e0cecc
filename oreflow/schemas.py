"""The data contract: columns, widths, keys and references per layer.

This metadata is the one extension point: checks, conforming and ingest are all driven by it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    DataType, DateType, DecimalType, IntegerType, LongType, StringType, StructField, StructType, TimestampType,
)


INT, BIGINT, DATE, MONEY, TIMESTAMP = IntegerType(), LongType(), DateType(), DecimalType(10, 2), TimestampType()
ANY_TEXT = StringType()


def text(width: int) -> tuple[StringType, int]:
    """Text with a declared width.  Spark does not enforce it, so it travels as metadata."""
    return StringType(), width


def table(**columns: DataType | tuple[StringType, int]) -> StructType:
    """A schema with its columns in the order given."""
    fields = []
    for name, kind in columns.items():
        kind, width = kind if isinstance(kind, tuple) else (kind, None)
        fields.append(StructField(name, kind, True, {"width": width} if width else {}))
    return StructType(fields)


def text_table(**widths: int) -> StructType:
    """An all-text table, columns in file order."""
    return table(**{name: text(width) for name, width in widths.items()})


def declared_widths(schema: StructType) -> dict[str, int]:
    return {f.name: f.metadata["width"] for f in schema if "width" in f.metadata}


@dataclass(frozen=True)
class Reference:
    """``source.column`` must occur in ``target.target_column``."""

    source: str
    column: str
    target: str
    target_column: str
    allow_null: bool = False

    def __str__(self) -> str:
        return f"{self.source}.{self.column}->{self.target}.{self.target_column}"


@dataclass(frozen=True)
class Layer:
    name: str
    tables: dict[str, StructType]
    keys: dict[str, tuple[str, ...]]
    references: tuple[Reference, ...] = ()


# Columns in file order with their width budgets.
BRONZE = Layer(
    "bronze",
    {
        "crm_cust_info": text_table(
            cst_id=12, cst_key=17, cst_firstname=45, cst_lastname=45,
            cst_marital_status=5, cst_gndr=5, cst_create_date=20,
        ),
        "crm_prd_info": text_table(
            prd_id=8, prd_key=23, prd_nm=50, prd_cost=12, prd_line=5, prd_start_dt=20, prd_end_dt=20,
        ),
        "crm_sales_details": text_table(
            sls_ord_num=12, sls_prd_key=17, sls_cust_id=10, sls_order_dt=20, sls_ship_dt=20,
            sls_due_dt=20, sls_sales=12, sls_quantity=10, sls_price=12,
        ),
        "erp_cust_az12": text_table(cid=18, bdate=20, gen=10),
        "erp_loc_a101": text_table(cid=16, cntry=30),
        "erp_px_cat_g1v2": text_table(id=10, cat=30, subcat=35, maintenance=5),
    },
    keys={},
)

SILVER = Layer(
    "silver",
    {
        "crm_cust_info": table(
            cst_id=INT, cst_key=text(10), cst_firstname=text(45), cst_lastname=text(45),
            cst_marital_status=text(7), cst_gndr=text(6), cst_create_date=DATE,
        ),
        "crm_prd_info": table(
            prd_id=INT, cat_id=text(5), prd_key=text(14), prd_nm=text(50), prd_cost=MONEY,
            prd_line=text(13), prd_start_dt=DATE, prd_end_dt=DATE,
        ),
        "crm_sales_details": table(
            sls_ord_num=INT, sls_prd_key=text(12), sls_cust_id=INT, sls_order_dt=DATE, sls_ship_dt=DATE,
            sls_due_dt=DATE, sls_sales=MONEY, sls_quantity=INT, sls_price=MONEY,
            sls_incomplete_financial_data=text(1),
        ),
        "erp_cust_az12": table(cid=text(10), bdate=DATE, gen=text(6)),
        "erp_loc_a101": table(cid=text(10), cntry=text(14)),
        "erp_px_cat_g1v2": table(id=text(5), cat=text(11), subcat=text(17), maintenance=text(3)),
    },
    keys={
        "crm_cust_info": ("cst_id",),
        "crm_prd_info": ("prd_id",),
        "crm_sales_details": ("sls_ord_num", "sls_prd_key"),
        "erp_cust_az12": ("cid",),
        "erp_loc_a101": ("cid",),
        "erp_px_cat_g1v2": ("id",),
    },
    references=(
        Reference("crm_cust_info", "cst_key", "erp_cust_az12", "cid"),
        Reference("crm_cust_info", "cst_key", "erp_loc_a101", "cid"),
        Reference("crm_sales_details", "sls_cust_id", "crm_cust_info", "cst_id"),
        Reference("crm_sales_details", "sls_prd_key", "crm_prd_info", "prd_key"),
        Reference("crm_prd_info", "cat_id", "erp_px_cat_g1v2", "id"),
    ),
)

GOLD = Layer(
    "gold",
    {
        "dim_customer": table(
            customer_id=INT, first_name=text(45), last_name=text(45), marital_status=text(7),
            gender=text(6), created_date=DATE, birth_date=DATE, country_of_residence=text(14),
        ),
        "dim_product": table(
            product_id=INT, product_key=text(14), product_name=text(50), category=text(11),
            product_line=text(13), subcategory=text(17), maintenance_required=text(3), cost=MONEY,
            start_date=DATE, end_date=DATE,
        ),
        "fact_sales": table(
            order_number=INT, product_id=INT, product_key=text(14), customer_id=INT, order_date=DATE,
            ship_date=DATE, delivery_date=DATE, sales=MONEY, quantity=INT, price=MONEY,
            is_incomplete_financial_data=text(1), err_date_lifecycle=text(1), err_date_sequence=text(1),
        ),
    },
    keys={
        "dim_customer": ("customer_id",),
        "dim_product": ("product_id",),
        "fact_sales": ("order_number", "product_key"),
    },
    references=(
        Reference("fact_sales", "customer_id", "dim_customer", "customer_id"),
        Reference("fact_sales", "product_id", "dim_product", "product_id", allow_null=True),
        Reference("fact_sales", "product_key", "dim_product", "product_key"),
    ),
)

RUN_EVENTS = table(
            run_id=ANY_TEXT, layer=text(6), step=ANY_TEXT, event_time=TIMESTAMP, started_at=TIMESTAMP,
            ended_at=TIMESTAMP, status=text(7), validation_status=text(7), rows_read=BIGINT,
            rows_written=BIGINT, referential_integrity=ANY_TEXT, null_key_check=ANY_TEXT,
            duplicate_key_check=ANY_TEXT, error_class=text(50), error_message=ANY_TEXT,
        )
