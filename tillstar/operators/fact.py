"""The order-line fact, its joins and row predicates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.functions.columns import date_key
from tillstar.session import broadcast_stores
from tillstar.sources.schemas import GOLD
from tillstar.star import Star


def net_revenue() -> Column:
    """Net revenue of a line, rounded to 2 decimals."""
    gross = F.col("quantity").cast("decimal(10,0)") * F.col("unit_price")
    return F.round(gross * (1 - F.col("discount_pct")), 2).cast("decimal(18,2)")


def line_amounts(lines: DataFrame) -> DataFrame:
    """Add net revenue, discount and cost of a line, each rounded to 2 decimals."""
    q = F.col("quantity").cast("decimal(10,0)")
    gross = q * F.col("unit_price")
    money = "decimal(18,2)"
    return lines.withColumns(
        {
            "net_revenue": net_revenue(),
            "discount_amount": F.round(gross * F.col("discount_pct"), 2).cast(money),
            "cost": F.round(q * F.col("unit_cost"), 2).cast(money),
        }
    )


# What the order lines have of a line's product and customer, beside the keys.
MEMBERS = {"product": ("category",), "customer": ("segment",)}
MEASURED = ("quantity", "unit_price", "discount_pct", "unit_cost", "is_returned")


def placed_lines(stg: DataFrame, dim_store: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Staged lines with the surrogate keys of stores and products; the date key is derived, not joined.

    Stores join on their whole natural key, so a store name used in two cities
    does not multiply lines; they are counted and broadcast up to 64 MB, as their texts would travel with
    every line. Amounts come later: ``unit_cost`` alone travels through
    the joins in place of three of them.
    """
    store = ["store_name", "city", "state", "country"]
    stores = broadcast_stores(dim_store.select("store_key", *store), dim_store.count())
    product = MEMBERS["product"]
    return (
        stg.drop(*product)
        .withColumn("date_key", date_key("order_date"))
        .join(stores, store)
        .join(dim_product.select("product_key", "sku", *product), "sku")
    )


def with_customers(lines: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Lines with their customer's key and ``MEMBERS``."""
    customer = MEMBERS["customer"]
    return lines.drop(*customer).join(dim_customer.select("customer_key", "customer_id", *customer), "customer_id")


def keyed_lines(stg: DataFrame, dim_customer: DataFrame, dim_store: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Staged lines with all surrogate keys. Customers join last, so that a customer's lines lie together.
    ``MEMBERS`` are those of the dimensions, not the line's own."""
    return with_customers(placed_lines(stg, dim_store, dim_product), dim_customer)


def stored_lines(placed: DataFrame) -> DataFrame:
    """The columns of ``placed_lines`` that the customers' dimension, the fact and the order lines are made of."""
    customer = ("customer_id", *MEMBERS["customer"], "signup_date")
    return placed.select("order_id", "channel", *customer, *MEMBERS["product"], "store_key", "product_key", "date_key", *MEASURED)


def stored_keys(keyed: DataFrame) -> DataFrame:
    """The columns of ``keyed_lines`` that the fact and the order lines are made of."""
    keys = ("customer_key", "store_key", "product_key", "date_key")
    return keyed.select("order_id", "customer_id", *MEMBERS["customer"], *MEMBERS["product"], *keys, "channel", *MEASURED)


def fact_rows(keyed: DataFrame, *more: str) -> DataFrame:
    """The fact's columns, amounts included, and ``more`` of the lines' own."""
    contract = [F.col(f.name).cast(f.dataType).alias(f.name) for f in GOLD["fact_sales"].fields]
    return line_amounts(keyed).select(*contract, *more)


def build_fact(stg: DataFrame, dim_customer: DataFrame, dim_store: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Natural keys out, surrogate keys in, amounts computed behind the joins."""
    return fact_rows(keyed_lines(stg, dim_customer, dim_store, dim_product))


def star_join(star: Star) -> DataFrame:
    """Every fact row with all attributes of its four dimensions."""
    columns = [c for dim in star.dims().values() for c in dim.columns]
    return star.sales(*columns)


def orphan_keys(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """One row (check_name, failures): fact rows whose key the dimension lacks.

    Keys are counted per distinct value first, so a hot key is one row in the join.
    """
    used = fact.groupBy(key).agg(F.count("*").alias("rows"))
    lost = used.join(dim.select(key), key, "left_anti")
    return lost.agg(F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("failures")).select(
        F.lit(f"orphan {key}").alias("check_name"), "failures"
    )


def order_lines(star: Star) -> DataFrame:
    """The denormalised analytic frame: fact with customer, date and product attributes.

    Customers are joined last: where that join shuffles, a customer's lines end in one partition,
    and what is counted per customer or order is first reduced there. A star that still has the placed
    lines its fact was made of starts from these: they lie in buckets of their customer, so only the customers are shuffled.
    """
    if star.keyed is not None:
        days = star.dim_date.select("date_key", "date")
        keyed = with_customers(star.keyed, star.dim_customer.hint("shuffle_hash"))
        lines = keyed.withColumn("net_revenue", net_revenue()).join(days, "date_key")
    else:
        dated = star.sales("date", "category")
        lines = dated.join(star.dim_customer.select("customer_key", "customer_id", "segment"), "customer_key")
    return lines.select(
        "customer_id", "segment", F.col("date").alias("order_date"), "order_id", "channel",
        "net_revenue", "discount_pct", "is_returned", "category",
    )


def kept(lines: DataFrame) -> DataFrame:
    return lines.filter(~F.col("is_returned"))


def _as_date(d: str | dt.date) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(d)


def _key(d: str | dt.date) -> int:
    d = _as_date(d)
    return d.year * 10000 + d.month * 100 + d.day


def in_period(
    fact: DataFrame,
    year: int | None = None,
    fy: int | None = None,
    between: tuple[str, str] | None = None,
    fy_start_month: int = 4,
) -> DataFrame:
    """Fact rows of a calendar year, a fiscal year or a closed date range.

    All three become a range on ``date_key`` (pushed to the parquet scan) and,
    where the fact is partitioned by year and month, ranges on the partition columns.
    """
    if sum(x is not None for x in (year, fy, between)) != 1:
        raise ValueError("give exactly one of year, fy, between")
    if year is not None:
        first, last = dt.date(year, 1, 1), dt.date(year, 12, 31)
    elif fy is not None:
        start = dt.date(fy - (fy_start_month > 1), fy_start_month, 1)
        first, last = start, dt.date(start.year + 1, start.month, 1) - dt.timedelta(days=1)
    else:
        first, last = (_as_date(d) for d in between)
    condition: Column = F.col("date_key").between(_key(first), _key(last))
    if "year" in fact.columns:
        condition &= F.col("year").between(first.year, last.year)
    if "year_month_key" in fact.columns:
        condition &= F.col("year_month_key").between(_key(first) // 100, _key(last) // 100)
    return fact.filter(condition)


def asof(lines: DataFrame, snapshot: str, date: str = "order_date") -> DataFrame:
    """Rows up to and including the snapshot day."""
    return lines.filter(F.col(date) <= F.lit(_as_date(snapshot)))


def after(lines: DataFrame, snapshot: str, horizon_end: str, date: str = "order_date") -> DataFrame:
    """Rows in (snapshot, horizon_end]."""
    return lines.filter((F.col(date) > F.lit(_as_date(snapshot))) & (F.col(date) <= F.lit(_as_date(horizon_end))))


def trailing(lines: DataFrame, snapshot: str, days: int = 90, date: str = "order_date") -> DataFrame:
    """Rows in (snapshot - days, snapshot]."""
    start = _as_date(snapshot) - dt.timedelta(days=days)
    return after(lines, start, snapshot, date)


def order_dedup(lines: DataFrame, customer: str = "customer_id") -> DataFrame:
    """One row per order with a repeatable choice of customer, date and channel.

    The lines are reduced by hash to the distinct (order, customer, channel)
    first: the text ``min`` of the second step sorts about one row per order.
    """
    seen = lines.groupBy("order_id", customer, "channel").agg(F.min("order_date").alias("order_date"))
    return seen.groupBy("order_id").agg(
        F.min(customer).alias(customer), F.min("order_date").alias("order_date"), F.min("channel").alias("channel")
    )
