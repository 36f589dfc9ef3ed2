"""Order lines derived from the order-entry tables (region ... lineitem)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.session import BROADCAST_BYTES, STORE_BYTES

TABLES = ("region", "nation", "supplier", "part", "customer", "orders", "lineitem")


def _code(prefix: str, key: str) -> Column:
    """Prefix and zero-padded number; a number longer than nine digits stays whole."""
    digits = F.col(key).cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.lit(9), F.length(digits)), F.lit("0")))


def bind_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One denormalised row per line item, with the raw order-line columns.

    Dimension-like tables are joined to each other first (nation-region-supplier,
    orders-customer), so the line items are joined three times only. Orders and
    line items both grow with the data: those joins are sort-merge joins, whose
    hot keys AQE splits. Stores, of which there are far fewer, are counted and broadcast up to
    64 MB, as Catalyst overrates the size of their joins and AQE learns it only when the line items have
    been shuffled; whether products are is left to the byte limit and to AQE. Where they are not, the line
    items are shuffled once per join, so texts that follow from a key are made behind the last join; the products' key
    is their text already, so that the lines leave the join dealt by ``sku`` and can be written so.
    """
    t = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in TABLES}
    places = t["nation"].join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    stores = t["supplier"].join(places, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("l_suppkey"),
        F.col("s_name").alias("store_name"),
        F.col("n_name").alias("state"),
        F.col("r_name").alias("country"),
    )
    products = t["part"].select(
        _code("SKU-", "p_partkey").alias("l_partkey"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.concat("p_type", F.lit("/"), (F.col("p_size") % 5).cast("string")).alias("subcategory"),
        F.col("p_brand").alias("brand"),
        # Narrow on purpose: price x share then stays within 18 digits, Spark's fast decimals.
        (F.lit(Decimal("0.550")) + F.col("p_size") * F.lit(Decimal("0.005"))).cast("decimal(5,3)").alias("cost_share"),
    )
    ordered = t["orders"].withColumn("order_date", F.col("o_orderdate").cast("date"))
    # One row per customer before the join: a customer with very many orders is not a hot group.
    signup = ordered.groupBy("o_custkey").agg(F.min("order_date").alias("signup_date"))
    people = t["customer"].join(signup, F.col("c_custkey") == F.col("o_custkey")).select(
        F.col("c_custkey").alias("o_custkey"),
        F.col("c_mktsegment").alias("segment"),
        "signup_date",
    )
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    headers = ordered.join(people.hint("merge"), "o_custkey").select(
        F.col("o_orderkey").alias("l_orderkey"),
        "order_date",
        "o_custkey",
        "segment",
        "signup_date",
        urgent.alias("urgent"),
    )
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    lines = t["lineitem"].join(headers.hint("merge"), "l_orderkey").withColumn("l_partkey", _code("SKU-", "l_partkey"))
    if t["supplier"].count() * STORE_BYTES <= BROADCAST_BYTES:
        lines = lines.join(products, "l_partkey").join(F.broadcast(stores), "l_suppkey")  # behind the last shuffle
    else:
        lines = lines.join(stores, "l_suppkey").join(products, "l_partkey")
    return (
        lines.select(
            _code("SO-", "l_orderkey").alias("order_id"), "order_date", _code("C", "o_custkey").alias("customer_id"), "segment", "signup_date",
            "store_name", F.concat("state", F.lit("-"), (F.col("l_suppkey") % 2).cast("string")).alias("city"), "state", "country",
            F.when(F.col("urgent"), "Online").otherwise("Store").alias("channel"),
            F.col("l_partkey").alias("sku"), "product_name", "category", "subcategory", "brand",
            F.col("l_quantity").cast("int").alias("quantity"),
            price.alias("unit_price"),
            F.col("l_discount").cast("decimal(5,4)").alias("discount_pct"),
            F.round(price * F.col("cost_share"), 2).cast("decimal(12,2)").alias("unit_cost"),
            (F.col("l_returnflag") == "R").alias("is_returned"),
        )
    )
