"""Ranking metrics of a score: AUC, average precision, quantile, lift.

All of them read one *curve*: counts per distinct score with running sums from
the highest score down. The running sums are distributed, so a score with as
many distinct values as rows needs no one-task window or sort.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.operators.keys import with_running_sums
from tillstar.session import materialize

_BIG = "decimal(38,0)"
#: Size of quantile sketches; the rank error falls about with its inverse.
SKETCH_K = 200


def score_curve(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """(by, score, n, pos, n_to, pos_to): counts per distinct score and running sums
    over everything at or above it, in order of ``by`` and falling score. Written once,
    as every metric reads it."""
    counts = df.groupBy(*by, F.col(score).alias("score")).agg(
        F.count("*").alias("n"), F.sum(F.col(label).cast("long")).alias("pos")
    )
    sums = with_running_sums(counts, [*by, F.desc("score")], {"n_to": "n", "pos_to": "pos"}, "score-order")
    return materialize(sums, "curve")


def roc_auc(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Share of (positive, negative) pairs ranked right, ties counting half.

    Sums are exact integers; one division at the end. Running sums that began
    in an earlier ``by`` group are corrected with the group's smallest value.
    """
    neg = F.col("n") - F.col("pos")
    neg_above = F.col("n_to") - F.col("pos_to") - neg
    lost = F.col("pos").cast(_BIG) * (neg_above * 2 + neg)
    agg = curve.groupBy(*by).agg(
        F.sum("pos").cast(_BIG).alias("P"),
        F.sum(neg).cast(_BIG).alias("N"),
        F.sum(lost).cast(_BIG).alias("lost"),
        F.min(neg_above).cast(_BIG).alias("before"),
    )
    pairs = F.col("P").cast("double") * F.col("N").cast("double") * 2
    wrong = F.col("lost").cast("double") - F.col("before").cast("double") * F.col("P").cast("double") * 2
    return agg.select(*by, (F.lit(1.0) - F.try_divide(wrong, pairs)).alias("roc_auc"))


def average_precision(curve: DataFrame) -> DataFrame:
    """Sum of precision x recall step over the distinct scores (no interpolation)."""
    precision = F.col("pos_to") / F.col("n_to")
    agg = curve.agg(F.sum(F.col("pos") * precision).alias("area"), F.sum("pos").alias("P"))
    return agg.select(F.try_divide("area", "P").alias("average_precision"))


def quantile(curve: DataFrame, q: float) -> DataFrame:
    """q-quantile of the scores with linear interpolation, from the two rows it lies between.

    Only the total count (one number) passes through the driver.
    """
    total = curve.agg(F.sum("n")).first()[0] or 0
    at = (total - 1) * q
    low, share = math.floor(at), at - math.floor(at)
    first = F.lit(total) - F.col("n_to")  # ascending position of a score's first row

    def value_at(i: int):
        inside = (first <= i) & (first + F.col("n") > i)
        return F.max(F.when(inside, F.col("score")))

    pair = curve.agg(value_at(low).alias("lo"), value_at(min(low + 1, total - 1)).alias("hi"))
    return pair.select((F.col("lo") + (F.col("hi") - F.col("lo")) * share).alias("threshold"))


def quantile_sketches(df: DataFrame, score: str, by: Sequence[str] = (), k: int = SKETCH_K) -> DataFrame:
    """``by, scores``: a mergeable sketch of the scores per group, of bounded size whatever the number of rows.
    Sketches of parts (days, partitions, segments) are merged by ``sketched_quantile``."""
    return df.groupBy(*by).agg(F.kll_sketch_agg_double(F.col(score).cast("double"), F.lit(k)).alias("scores"))


def sketched_quantile(sketches: DataFrame, q: float, by: Sequence[str] = (), k: int = SKETCH_K) -> DataFrame:
    """q-quantile of the merged sketches: a score whose rank is within the sketches' error of q (``k`` 200: 1.65 %,
    at 99 % confidence); no order of the scores and no number passes through the driver."""
    merged = sketches.groupBy(*by).agg(F.kll_merge_agg_double("scores", F.lit(k)).alias("_s"))
    return merged.select(*by, F.kll_sketch_get_quantile_double("_s", F.lit(q)).alias("threshold"))


def lift(curve: DataFrame, q: float = 0.8) -> DataFrame:
    """Positive rate at or above the q-quantile, and its ratio to the overall rate."""
    threshold = quantile(curve, q).first()[0]
    top = F.col("score") >= F.lit(threshold)
    agg = curve.agg(
        F.sum(F.when(top, F.col("pos"))).alias("top_pos"),
        F.sum(F.when(top, F.col("n"))).alias("top_n"),
        F.sum("pos").alias("P"),
        F.sum("n").alias("n"),
    )
    rate = F.try_divide(F.col("top_pos").cast("double"), F.col("top_n"))
    overall = F.try_divide(F.col("P").cast("double"), F.col("n"))
    return agg.select(
        F.lit(threshold).alias("threshold"),
        F.col("top_n").alias("top_customers"),
        rate.alias("top_rate"),
        F.try_divide(rate, overall).alias("lift"),
    )
