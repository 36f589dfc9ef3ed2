"""Customer features at a snapshot, the churn label and RFM scores."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.functions.columns import pct_one_decimal, quartile, ratio, rfm_segment
from tillstar.operators.fact import after, asof, order_dedup
from tillstar.operators.keys import with_dense_key

FEATURES = (
    "recency_days", "tenure_days", "frequency", "monetary", "avg_order_value", "avg_discount",
    "online_share", "n_categories", "return_rate", "orders_last_90d", "is_corporate", "orders_per_month",
)

ACTIVE_DAYS = 365


def _date(d: str | dt.date) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(d)


def customer_features(lines: DataFrame, snapshot: str | dt.date, corporate: str = "Corporate") -> DataFrame:
    """Twelve features per customer from the order lines up to the snapshot (returns included).

    One line-level and one order-level aggregation and one of the categories, all ending on
    ``customer_id``, so their joins need no further shuffle. Categories are
    counted after a reduction to distinct (customer, category); as there are about as many of
    these as lines, they travel without the sums. Money and
    discounts are summed as decimals and divided as doubles at the end.
    """
    day = F.lit(_date(snapshot))
    hist = asof(lines, _date(snapshot))
    per_customer = hist.groupBy("customer_id").agg(
        F.max("order_date").alias("last"),
        F.min("order_date").alias("first"),
        F.sum("net_revenue").alias("monetary"),
        F.coalesce(F.sum(F.when(F.col("order_date") > F.add_months(day, -12), F.col("net_revenue"))), F.lit(0)).alias("monetary_12m"),
        F.sum("discount_pct").alias("discount"),
        F.count("*").alias("lines"),
        F.count_if("is_returned").alias("returned"),
        F.max((F.col("segment") == corporate).cast("int")).alias("is_corporate"),
    )
    categories = hist.select("customer_id", "category").distinct()
    per_category = categories.groupBy("customer_id").agg(F.count("category").cast("int").alias("n_categories"))
    recent = F.col("order_date") > F.date_sub(day, 90)
    per_order = (
        order_dedup(hist)
        .groupBy("customer_id")
        .agg(
            F.count("*").cast("int").alias("frequency"),
            F.count_if(F.col("channel") == "Online").alias("online"),
            F.count_if(recent).cast("int").alias("orders_last_90d"),
        )
    )
    tenure = F.datediff(day, "first")
    return per_customer.join(per_category, "customer_id").join(per_order, "customer_id").select(
        "customer_id",
        F.datediff(day, "last").alias("recency_days"),
        tenure.alias("tenure_days"),
        "frequency",
        F.col("monetary").cast("decimal(28,2)").alias("monetary"),
        ratio("monetary", "frequency").alias("avg_order_value"),
        ratio("discount", "lines").alias("avg_discount"),
        ratio("online", "frequency").alias("online_share"),
        "n_categories",
        ratio("returned", "lines").alias("return_rate"),
        "orders_last_90d",
        F.coalesce("is_corporate", F.lit(0)).alias("is_corporate"),
        (F.col("frequency") / F.greatest(tenure / F.lit(30.0), F.lit(1.0))).alias("orders_per_month"),
        F.col("monetary_12m").cast("decimal(28,2)").alias("monetary_12m"),
    )


def active_customers(features: DataFrame, days: int = ACTIVE_DAYS) -> DataFrame:
    return features.filter(F.col("recency_days") <= days)


def churn_label(lines: DataFrame, features: DataFrame, snapshot: str | dt.date, horizon_end: str | dt.date) -> DataFrame:
    """Adds ``churned``: 0 for a customer who buys in (snapshot, horizon_end], else 1."""
    buyers = after(lines, _date(snapshot), _date(horizon_end)).select("customer_id").distinct()
    flagged = buyers.withColumn("_bought", F.lit(True))
    labelled = features.join(flagged, "customer_id", "left")
    return labelled.withColumn("churned", F.when(F.col("_bought"), 0).otherwise(1)).drop("_bought")


def rfm_scores(features: DataFrame) -> DataFrame:
    """R, F, M quarters (1..4) from unique ranks, plus the segment.

    The three metrics are ranked in one pass: (metric, value, customer) rows
    get one dense key in range order, and a metric's ranks are its keys less
    the keys of the metrics before it. No window sees a whole metric. Ties go
    by customer_id; recency ranks backwards.
    """
    metrics = {"F": "frequency", "M": "monetary", "R": "recency_days"}
    stacked = features.select(
        "customer_id",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(k).alias("metric"), F.col(c).cast("decimal(28,2)").alias("value"))
                    for k, c in metrics.items()
                ]
            )
        ).alias("m"),
    ).select("customer_id", "m.metric", "m.value")
    keyed = with_dense_key(stacked, ["metric", "value", "customer_id"], "position")
    spans = keyed.groupBy("metric").agg(F.min("position").alias("start"), F.count("*").alias("n"))  # three rows
    rank = F.col("position") - F.col("start") + 1
    ranked = keyed.join(F.broadcast(spans), "metric").select(
        "customer_id",
        "metric",
        quartile(F.when(F.col("metric") == "R", F.col("n") + 1 - rank).otherwise(rank), F.col("n")).alias("score"),
    )
    scores = ranked.groupBy("customer_id").agg(
        *[F.max(F.when(F.col("metric") == k, F.col("score"))).alias(k) for k in ("R", "F", "M")]
    )
    return scores.withColumn("segment", rfm_segment())


def segment_summary(segments: DataFrame) -> DataFrame:
    """Customers and churn % (one decimal) per RFM segment."""
    agg = segments.groupBy("segment").agg(
        F.count("*").alias("customers"), F.sum(F.col("churned").cast("long")).alias("churned")
    )
    return agg.select("segment", "customers", pct_one_decimal("churned", "customers").alias("churn_rate_pct"))
