"""Customer analytics: order lines to cohorts, features, segments, models and scores."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.functions.columns import pct_one_decimal
from tillstar.operators import churn, cohorts, features
from tillstar.operators.fact import order_dedup, order_lines
from tillstar.operators.keys import side_by_side
from tillstar.session import materialize, together
from tillstar.sources.files import write_gold, write_json
from tillstar.star import Star

# The reference snapshot and horizon; both are parameters.
SNAPSHOT = "2025-06-30"
HORIZON_END = "2025-12-31"


@dataclass(frozen=True)
class Base:
    """What the models start from; every frame is materialised."""

    lines: DataFrame
    cohorts: DataFrame
    labelled: DataFrame
    segments: DataFrame


@dataclass(frozen=True)
class Results:
    base: Base
    scores: DataFrame
    metrics: DataFrame
    drivers: DataFrame
    summary: DataFrame


def prepare(star: Star, snapshot: str = SNAPSHOT, horizon_end: str = HORIZON_END, corporate: str = "Corporate") -> Base:
    """Order lines, retention, and features + label + RFM of the active customers."""
    lines, days = order_lines(star), star.calendar_bounds()
    if star.keyed is None:  # else they are written already, where their customers lie
        lines = materialize(lines, "order-lines")
    active = features.active_customers(features.customer_features(lines, snapshot, corporate))
    retention, labelled = together(
        star.spark,
        lambda: materialize(cohorts.cohort_retention(order_dedup(lines), horizon_end, since=days["first"], until=days["last"]), "cohorts"),
        lambda: materialize(features.churn_label(lines, active, snapshot, horizon_end), "features"),
    )
    segments = materialize(features.rfm_scores(labelled), "rfm")
    return Base(lines, retention, labelled, segments)


def with_churn(base: Base) -> DataFrame:
    return base.segments.join(base.labelled.select("customer_id", "churned"), "customer_id")


def analytics_summary(base: Base, split: DataFrame, metrics: DataFrame, drivers: DataFrame, k: int = 5) -> DataFrame:
    """One nested row: sizes, model metrics, drivers, segments, month-3 retention.

    Every collected list is over a frame of fixed size (2 models, k drivers,
    5 segments, one entry per cohort quarter).
    """

    def listed(df: DataFrame, name: str, order: list) -> DataFrame:
        rows = df.select(F.struct(*[F.col(c) if isinstance(c, str) else c for c in order]).alias("r"))
        return rows.agg(F.array_sort(F.collect_list("r")).alias(name))

    sizes = split.agg(
        F.count("*").alias("n_customers"),
        pct_one_decimal(F.sum(F.col("churned").cast("long")), F.count("*")).alias("churn_rate_pct"),
        F.count_if("is_test").alias("test_size"),
    )
    parts = (
        listed(metrics, "models", metrics.columns),
        listed(churn.top_drivers(drivers, k), "top_drivers", [(-F.col("importance")).alias("rank"), "feature", "importance"]),
        listed(features.segment_summary(with_churn(base)), "rfm_segments", ["segment", "customers", "churn_rate_pct"]),
        listed(cohorts.month_retention(base.cohorts), "month3_retention_pct", ["cohort", "retention_pct"]),
    )
    return side_by_side(sizes, *parts)


def run(
    star: Star,
    snapshot: str = SNAPSHOT,
    horizon_end: str = HORIZON_END,
    n_trees: int = 300,
    corporate: str = "Corporate",
    folder: str | None = None,
    fmt: str = "csv",
) -> Results:
    """Everything from the star to scores and the summary; optionally exported to ``folder``."""
    base = prepare(star, snapshot, horizon_end, corporate)
    split = materialize(churn.train_test_split(base.labelled), "split")
    train, test = split.filter(~F.col("is_test")), split.filter("is_test")
    logistic, boosted = together(star.spark, lambda: churn.fit_logistic(train), lambda: churn.fit_gbt(train, n_trees))
    metrics = materialize(
        churn.evaluate(churn.with_probability(logistic, test), "logistic_regression").unionByName(
            churn.evaluate(churn.with_probability(boosted, test), "gradient_boosting")
        ),
        "metrics",
    )
    drivers = materialize(churn.permutation_attribution(boosted, test), "drivers")
    scored = churn.with_probability(boosted, base.labelled)
    scores = materialize(churn.score_frame(scored, base.segments, F.col("p")), "scores")
    summary = analytics_summary(base, split, metrics, drivers)
    if folder:
        write_gold({"customer_scores": scores, "cohort_retention": base.cohorts}, folder, fmt)
        write_json(summary, f"{folder}/customer_analytics.json")
    return Results(base, scores, metrics, drivers, summary)
