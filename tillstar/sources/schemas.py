"""Explicit schemas of every table boundary."""

from __future__ import annotations

from pyspark.sql import types as T
from pyspark.sql.types import StructField, StructType

TEXT, DATE, FLAG = T.StringType(), T.DateType(), T.BooleanType()
INT, LONG, DOUBLE = T.IntegerType(), T.LongType(), T.DoubleType()
PRICE, SHARE, MONEY = T.DecimalType(12, 2), T.DecimalType(5, 4), T.DecimalType(18, 2)


def _schema(**columns: T.DataType) -> StructType:
    return StructType([StructField(name, dtype) for name, dtype in columns.items()])


ORDER_LINES = _schema(
    order_id=TEXT, order_date=DATE, customer_id=TEXT, segment=TEXT, signup_date=DATE,
    store_name=TEXT, city=TEXT, state=TEXT, country=TEXT, channel=TEXT,
    sku=TEXT, product_name=TEXT, category=TEXT, subcategory=TEXT, brand=TEXT,
    quantity=INT, unit_price=PRICE, discount_pct=SHARE, unit_cost=PRICE, is_returned=FLAG,
)
ORDER_LINES_TEXT = tuple(f.name for f in ORDER_LINES.fields if f.dataType == TEXT)

# A raw extract is read as text; staging gives the types.
RAW_ORDER_LINES = _schema(**{f.name: TEXT for f in ORDER_LINES.fields})

GOLD: dict[str, StructType] = {
    "dim_date": _schema(
        date_key=INT, date=DATE, year=INT, quarter=INT, month=INT, month_name=TEXT, year_month=TEXT,
        is_weekend=FLAG, fiscal_year=INT,
    ),
    "dim_customer": _schema(customer_id=TEXT, segment=TEXT, signup_date=DATE, customer_key=LONG),
    "dim_store": _schema(store_name=TEXT, city=TEXT, state=TEXT, country=TEXT, region=TEXT, store_key=LONG),
    "dim_product": _schema(
        sku=TEXT, product_name=TEXT, category=TEXT, subcategory=TEXT, brand=TEXT, list_price=PRICE, product_key=LONG
    ),
    "fact_sales": _schema(
        order_id=TEXT, customer_key=LONG, store_key=LONG, product_key=LONG, channel=TEXT, quantity=INT,
        unit_price=PRICE, discount_pct=SHARE, is_returned=FLAG, date_key=INT, net_revenue=MONEY,
        discount_amount=MONEY, cost=MONEY,
    ),
    "security_user_country": _schema(user_email=TEXT, country=TEXT),
    "customer_scores": _schema(
        customer_id=TEXT, R=INT, F=INT, M=INT, segment=TEXT, churned_h2_2025=INT, recency_days=INT, frequency=INT,
        monetary=DOUBLE, churn_probability=DOUBLE, churn_risk=TEXT,
    ),
    "cohort_retention": _schema(cohort=TEXT, months_since_first=INT, retention_pct=DOUBLE),
}

# The parquet fact also has the partition columns: year, and year x 100 + month.
FACT_ON_DISK = StructType([*GOLD["fact_sales"].fields, StructField("year", INT), StructField("year_month_key", INT)])

# (from table, column) -> (to table, column): many-to-one, single direction.
RELATIONSHIPS = {
    ("fact_sales", "date_key"): ("dim_date", "date_key"),
    ("fact_sales", "customer_key"): ("dim_customer", "customer_key"),
    ("fact_sales", "store_key"): ("dim_store", "store_key"),
    ("fact_sales", "product_key"): ("dim_product", "product_key"),
    ("customer_scores", "customer_id"): ("dim_customer", "customer_id"),
}
