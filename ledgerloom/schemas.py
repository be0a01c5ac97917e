"""The star schema: column types, text widths, keys and references.

Surrogate keys are BIGINT so that the schema also fits key ranges beyond INT.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Declared column types, as Spark DDL. (StructType.fromDDL needs a session, which
# is not there when a module is imported, so the few types are read here.)
_DECLARED = {
    "dim_date": """date_id date, year int, month int, day int, day_of_week varchar(10),
        is_weekend_sunday boolean, tamil_month varchar(15), festival_name varchar(30),
        season_tag varchar(20)""",
    "dim_store": "store_id bigint, store_name varchar(40), store_type varchar(20), location varchar(40)",
    "dim_product": """product_id bigint, category varchar(20), subcategory varchar(20),
        item_name varchar(60), brand_name varchar(50), price_tier varchar(15),
        manufacturing_hub varchar(20), distribution_hub varchar(20), lead_time_days int,
        unit_cost decimal(10,2), unit_price decimal(10,2), hsn_code varchar(8),
        gst_rate decimal(4,2)""",
    "dim_customer": """customer_id bigint, customer_type varchar(20), home_area varchar(30),
        first_purchase_date date, preferred_category varchar(20), customer_tenure_days int""",
    "dim_employee": """employee_id bigint, role varchar(40), employment_type varchar(15),
        monthly_salary decimal(10,2), join_date date, store_id bigint""",
    "dim_promotion": """promotion_id bigint, promotion_name varchar(50), start_date date,
        end_date date, target_category varchar(20), discount_pct decimal(5,2)""",
    "fact_sales": """transaction_id varchar(20), invoice_number varchar(20), date_id date,
        store_id bigint, employee_id bigint, product_id bigint, customer_id bigint,
        promotion_id bigint, quantity int, unit_price decimal(10,2),
        discount_pct decimal(5,2), gross_amount decimal(12,2), net_amount decimal(12,2),
        payment_mode varchar(10), gross_margin decimal(12,2), is_wholesale_bulk boolean,
        is_high_value boolean""",
    "fact_stock": """stock_event_id bigint, date_id date, product_id bigint,
        event_type varchar(15), quantity_change decimal(10,2), stock_on_hand decimal(10,2)""",
    "fact_purchase_order": """po_id bigint, product_id bigint, order_date date,
        expected_delivery_date date, actual_delivery_date date, quantity_ordered int,
        quantity_received decimal(10,2), po_status varchar(20), days_to_deliver decimal(10,2)""",
    "fact_payment_settlement": """settlement_id bigint, date_id date, payment_mode varchar(10),
        gross_amount_settled decimal(12,2), settlement_status varchar(15)""",
    "fact_opex": """opex_id bigint, month date, expense_type varchar(25), amount decimal(12,2),
        headcount decimal(10,2), store_id bigint""",
}
_DECLARED["fact_sales_quarantine"] = _DECLARED["fact_sales"] + ", quarantine_reason varchar(200)"

# Columns the job adds; a raw file does not have them.
DERIVED = {
    "dim_customer": ("customer_tenure_days",),
    "fact_sales": ("gross_margin", "is_wholesale_bulk", "is_high_value"),
    "fact_purchase_order": ("days_to_deliver",),
}

# Columns a raw file may lack.
OPTIONAL = {"fact_opex": {"headcount"}}

# Folder columns a star table has beside the declared ones.
LAYOUT = {"fact_sales": ("sale_month",)}

# Notes on a row: texts of values that cannot be loaded, and of values read as missing by rule.
# Each is `column=value; ...`, NULL if there are none. A row with a refused value is not loaded.
REFUSED = "refused_values"
UNREADABLE = "unreadable_values"

PRIMARY_KEYS = {
    "dim_date": "date_id",
    "dim_store": "store_id",
    "dim_product": "product_id",
    "dim_customer": "customer_id",
    "dim_employee": "employee_id",
    "dim_promotion": "promotion_id",
    "fact_stock": "stock_event_id",
    "fact_purchase_order": "po_id",
    "fact_payment_settlement": "settlement_id",
    "fact_opex": "opex_id",
}

# (table, column, referenced table); the column refers to that table's key.
REFERENCES = (
    ("dim_employee", "store_id", "dim_store"),
    ("fact_sales", "date_id", "dim_date"),
    ("fact_sales", "store_id", "dim_store"),
    ("fact_sales", "employee_id", "dim_employee"),
    ("fact_sales", "product_id", "dim_product"),
    ("fact_sales", "customer_id", "dim_customer"),
    ("fact_sales", "promotion_id", "dim_promotion"),
    ("fact_stock", "product_id", "dim_product"),
    ("fact_purchase_order", "product_id", "dim_product"),
    ("fact_opex", "store_id", "dim_store"),
)

REQUIRED = {
    "dim_product": (
        "category", "item_name", "brand_name", "price_tier", "manufacturing_hub",
        "lead_time_days", "unit_cost", "unit_price",
    )
}

# The ten tables that arrive as raw text files; dim_date arrives clean.
RAW_TABLES = (
    "fact_sales", "dim_product", "dim_employee", "dim_promotion", "fact_purchase_order",
    "fact_stock", "dim_customer", "fact_payment_settlement", "dim_store", "fact_opex",
)


_PLAIN = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "date": T.DateType(),
    "boolean": T.BooleanType(),
}


def _field(declaration: str) -> T.StructField:
    name, kind = declaration.split()
    if kind in _PLAIN:
        return T.StructField(name, _PLAIN[kind])
    sizes = [int(n) for n in re.findall(r"\d+", kind)]
    if kind.startswith("decimal"):
        return T.StructField(name, T.DecimalType(*sizes))
    return T.StructField(name, T.StringType(), True, {"width": sizes[0]})


STAR = {
    table: T.StructType([_field(d) for d in re.split(r",\s*(?![^(]*\))", columns)])
    for table, columns in _DECLARED.items()
}


def joined_notes(notes: list[Column]) -> Column:
    if not notes:
        return F.lit(None).cast("string")
    return F.nullif(F.concat_ws("; ", *notes), F.lit(""))


def raw_columns(table: str) -> list[str]:
    return [f for f in STAR[table].fieldNames() if f not in DERIVED.get(table, ())]


def raw_schema(table: str) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in raw_columns(table)])
