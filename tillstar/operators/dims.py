"""Dimension builders with dense surrogate keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.functions.columns import date_key, fiscal_year
from tillstar.operators.keys import with_dense_key
from tillstar.sources.schemas import GOLD

DOMESTIC = "India"


def _as_contract(df: DataFrame, name: str) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in GOLD[name].fields])


def dim_date(stg: DataFrame, fy_start_month: int = 4) -> DataFrame:
    """Dense daily calendar, 1 January of the first year to 31 December of the last."""
    bounds = stg.agg(
        F.trunc(F.min("order_date"), "year").alias("first"),
        F.make_date(F.year(F.max("order_date")), F.lit(12), F.lit(31)).alias("last"),
    ).filter(F.col("first").isNotNull())
    days = bounds.select(F.explode(F.sequence("first", "last")).alias("date"))
    d = F.col("date")
    calendar = days.select(
        date_key(d).alias("date_key"),
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMM").alias("month_name"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        fiscal_year(d, fy_start_month).alias("fiscal_year"),
    )
    return _as_contract(calendar, "dim_date")


def dim_customer(stg: DataFrame) -> DataFrame:
    """One row per customer; ``min`` makes the 'any' segment repeatable.

    A text ``min`` makes Spark sort its input, so the lines are first reduced
    by hash to the distinct (customer, segment), about one row per customer.
    """
    seen = stg.groupBy("customer_id", "segment").agg(F.min("signup_date").alias("signup_date"))
    customers = seen.groupBy("customer_id").agg(
        F.min("segment").alias("segment"), F.min("signup_date").alias("signup_date")
    )
    return _as_contract(with_dense_key(customers, ["customer_id"], "customer_key"), "dim_customer")


def distinct_stores(stg: DataFrame) -> DataFrame:
    return stg.select("store_name", "city", "state", "country").distinct()


def dim_store(stg: DataFrame, domestic: str = DOMESTIC) -> DataFrame:
    region = F.when(F.col("country") == domestic, "Domestic").otherwise("International")
    stores = distinct_stores(stg).withColumn("region", region)
    keyed = with_dense_key(stores, ["country", "state", "city", "store_name"], "store_key")
    return _as_contract(keyed, "dim_store")


def dim_product(stg: DataFrame) -> DataFrame:
    """One row per sku; the highest unit price seen is the list price.

    Reduced by hash to the distinct attribute sets first, as for customers.
    """
    attributes = ("product_name", "category", "subcategory", "brand")
    seen = stg.groupBy("sku", *attributes).agg(F.max("unit_price").alias("list_price"))
    products = seen.groupBy("sku").agg(
        *[F.min(c).alias(c) for c in attributes], F.max("list_price").alias("list_price")
    )
    return _as_contract(with_dense_key(products, ["sku"], "product_key"), "dim_product")
