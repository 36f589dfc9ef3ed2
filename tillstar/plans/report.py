"""Report datasets: each visual of the two report pages as one table."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.functions.columns import risk_order
from tillstar.operators.cohorts import MAX_MONTHS, cohort_pivot
from tillstar.operators.fact import in_period
from tillstar.operators.keys import side_by_side
from tillstar.operators.measures import measure, retention_measure, score_measures
from tillstar.operators.ranking import revenue_by, with_share_of_parent
from tillstar.operators.rollups import hierarchy
from tillstar.operators.security import secure_user
from tillstar.operators.timeintel import time_calc
from tillstar.star import Star


def _bounds(star: Star):
    b = star.calendar_bounds()
    return b["first"], b["last"]


def overview_kpis(star: Star, fy: int, fy_start_month: int = 4) -> DataFrame:
    """Revenue, orders, average order value and YoY % of a fiscal year (four cards)."""
    cards = measure(star, ["total_revenue", "orders", "avg_order_value"], period=partial(in_period, fy=fy, fy_start_month=fy_start_month))
    two = in_period(star.fact_sales, between=(f"{fy - 2}-01-01", f"{fy}-12-31"))
    growth = time_calc(two, _bounds(star), "total_revenue", ["YoY %"], grain="fiscal_year", fy_start_month=fy_start_month)
    growth = growth.filter(F.col("period") == str(fy)).select(F.col("YoY %").alias("yoy_pct"))
    return side_by_side(cards, growth).select(F.lit(fy).alias("fiscal_year"), "*")


def fy_choices(star: Star) -> DataFrame:
    return star.dim_date.select("fiscal_year").distinct().orderBy("fiscal_year")


def monthly_trend(star: Star, fy: int, fy_start_month: int = 4) -> DataFrame:
    """Months of the fiscal year with revenue and the same month a year before."""
    months = star.dim_date.filter(F.col("fiscal_year") == fy).select("year_month").distinct()
    scope = in_period(star.fact_sales, between=(f"{fy - 2}-01-01", f"{fy}-12-31"))
    trend = time_calc(scope, _bounds(star), "total_revenue", ["Current", "PY"])
    return (
        trend.join(months, trend.period == months.year_month)
        .select("year_month", F.col("Current").alias("revenue"), F.col("PY").alias("revenue_py"))
        .orderBy("year_month")
    )


def geo_matrix(star: Star, fy: int | None = None) -> DataFrame:
    levels = ["country", "state", "city"]
    period = partial(in_period, fy=fy) if fy else None
    return with_share_of_parent(hierarchy(star, levels, ["total_revenue"], period), levels)


def channel_mix(star: Star, fy: int | None = None) -> DataFrame:
    return measure(star, "total_revenue", ["channel"], period=partial(in_period, fy=fy) if fy else None)


def category(star: Star, fy: int | None = None) -> DataFrame:
    return revenue_by(star, "category", partial(in_period, fy=fy) if fy else None)


def churn_kpis(scores: DataFrame, monetary: str = "monetary") -> DataFrame:
    return score_measures(scores, monetary=monetary).select(
        "customers_scored", "high_risk_pct", "revenue_at_risk", "observed_churn_pct"
    )


def risk_bands(scores: DataFrame) -> DataFrame:
    bands = score_measures(scores, ["churn_risk"]).withColumn("risk_order", risk_order("churn_risk"))
    return bands.select("churn_risk", "risk_order", "customers_scored").orderBy("risk_order")


def churn_by_segment(scores: DataFrame) -> DataFrame:
    rows = score_measures(scores, ["segment"]).select("segment", "observed_churn_pct")
    return rows.orderBy(F.desc("observed_churn_pct"), "segment")


def highest_risk_customers(scores: DataFrame, k: int | None = None) -> DataFrame:
    """The score table by falling probability, ties by customer_id; the first ``k`` where asked for."""
    columns = ("customer_id", "segment", "churn_probability", "recency_days", "monetary")
    rows = scores.select(*columns).orderBy(F.desc("churn_probability"), "customer_id")
    return rows if k is None else rows.limit(k)


def cohort_matrix(cohorts: DataFrame, max_months: int = MAX_MONTHS) -> DataFrame:
    """Retention % per cohort and month; ``cohorts`` in read form (a fraction)."""
    cells = retention_measure(cohorts, ["cohort", "months_since_first"])
    return cohort_pivot(cells, "retention_pct", max_months).orderBy("cohort")


OVERVIEW: dict[str, Callable[..., DataFrame]] = {
    "overview_kpis": overview_kpis,
    "fy_choices": lambda star, fy: fy_choices(star),
    "monthly_trend": monthly_trend,
    "geo_matrix": geo_matrix,
    "channel_mix": channel_mix,
    "category": category,
}
CHURN: dict[str, Callable[..., DataFrame]] = {
    "churn_kpis": churn_kpis,
    "risk_bands": risk_bands,
    "segment_churn": churn_by_segment,
    "highest_risk": highest_risk_customers,
}


def report(
    name: str,
    star: Star | None = None,
    scores: DataFrame | None = None,
    cohorts: DataFrame | None = None,
    fy: int | None = None,
    user: str | None = None,
    mapping: DataFrame | None = None,
) -> DataFrame:
    """One visual's table. ``user`` applies the mapped countries to the sales page;
    the score tables are not related to stores and stay unrestricted."""
    if name in OVERVIEW:
        visible = star if user is None else secure_user(star, mapping, user)
        return OVERVIEW[name](visible, fy)
    if name == "cohort_matrix":
        return cohort_matrix(cohorts)
    return CHURN[name](scores)
