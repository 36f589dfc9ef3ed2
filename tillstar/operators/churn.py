"""Churn models: split, fit (Newton steps; boosted trees of Spark ML), evaluate, score, explain."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.functions.columns import risk_band
from tillstar.operators.features import FEATURES
from tillstar.operators.keys import side_by_side, with_dense_key
from tillstar.operators.metrics import average_precision, lift, roc_auc, score_curve
from tillstar.session import materialize, scratch_root

LABEL = "churned"
ROWS_PER_TASK = 50_000  # training rows of one task in a boosting round


def train_test_split(
    df: DataFrame, label: str = LABEL, fraction: float = 0.25, seed: int = 42, key: str = "customer_id"
) -> DataFrame:
    """Adds ``is_test``: the given fraction of each label, picked by a seeded hash order.

    The same key and seed give the same side whatever the partitioning.
    """
    hashed = df.withColumn("_hash", F.md5(F.concat_ws(":", F.col(key), F.lit(str(seed)))))
    placed = with_dense_key(hashed, [label, "_hash", key], "_position")
    spans = placed.groupBy(label).agg(  # one row per label
        F.min("_position").alias("_start"), F.floor(F.count("*") * fraction + 0.5).alias("_take")
    )
    chosen = placed.join(F.broadcast(spans), label)
    return chosen.select(*df.columns, (F.col("_position") - F.col("_start") < F.col("_take")).alias("is_test"))


def assemble(df: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol="features").transform(df)


@dataclass(frozen=True)
class Logistic:
    """Weights of the standardised features, and what standardises them."""

    means: tuple[float, ...]
    spreads: tuple[float, ...]
    weights: tuple[float, ...]
    intercept: float

    def probability(self, values: Sequence[Column]) -> Column:
        return _sigmoid(_linear(values, self.means, self.spreads, self.weights, self.intercept))


def _sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def _linear(values: Sequence[Column], means, spreads, weights, intercept) -> Column:
    z = F.lit(float(intercept))
    for v, m, s, w in zip(values, means, spreads, weights, strict=True):
        if s:
            z = z + (v.cast("double") - float(m)) * float(w / s)
    return z


def fit_logistic(train: DataFrame, label: str = LABEL, columns: Sequence[str] = FEATURES, rounds: int = 50) -> Logistic:
    """Standardised features and L2 logistic regression with the penalty of C = 1, by Newton's method.

    A step is one aggregate: the gradient and the products of every two features, each weighted
    by p (1 - p), are 13 + 91 sums for 12 features, whatever the number of rows; the driver solves
    that small system. Without a random choice, and done when no weight moves any more.
    """
    columns = list(columns)
    values = [F.col(c).cast("double") for c in columns]
    found = train.agg(*[f(v) for v in values for f in (F.avg, F.stddev)]).first()
    means = tuple(float(x or 0) for x in found[::2])
    spreads = tuple(float(x or 0) for x in found[1::2])
    rows = train.select(F.col(label).cast("double").alias("_y"), *[v.alias(f"_{i}") for i, v in enumerate(values)])
    scaled = [(F.col(f"_{i}") - m) / s if s else F.lit(0.0) for i, (m, s) in enumerate(zip(means, spreads, strict=True))]
    rows = materialize(rows.select("_y", *[x.alias(f"_{i}") for i, x in enumerate(scaled)]), "standardised")
    size = len(columns) + 1
    x = [F.lit(1.0), *[F.col(f"_{i}") for i in range(size - 1)]]
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    beta = np.zeros(size)
    penalty = np.diag([0.0, *[1.0] * (size - 1)])
    for _ in range(rounds):
        z = _linear(x[1:], [0.0] * (size - 1), [1.0] * (size - 1), beta[1:].tolist(), beta[0])
        weighed = rows.withColumn("_p", _sigmoid(z)).withColumn("_h", F.col("_p") * (1 - F.col("_p")))
        sums = [F.sum((F.col("_p") - F.col("_y")) * v) for v in x] + [F.sum(F.col("_h") * x[i] * x[j]) for i, j in pairs]
        got = [float(v or 0) for v in weighed.agg(*sums).first()]
        hessian = np.zeros((size, size))
        for (i, j), v in zip(pairs, got[size:], strict=True):
            hessian[i, j] = hessian[j, i] = v
        step = np.linalg.lstsq(hessian + penalty, np.array(got[:size]) + penalty @ beta, rcond=None)[0]
        beta = beta - step
        if np.abs(step).max() < 1e-10:
            break
    return Logistic(means, spreads, tuple(beta[1:].tolist()), float(beta[0]))


def fit_gbt(
    train: DataFrame, n_trees: int = 300, label: str = LABEL, columns: Sequence[str] = FEATURES, seed: int = 42
) -> PipelineModel:
    """Boosted trees of depth 3, rate 0.05, 80 % subsample.

    Residuals are checkpointed in the shared folder, so 300 rounds do not build one long
    lineage. Each round is a few jobs over all partitions, so the training set is laid
    out in as many as its size needs and cached for the rounds.
    """
    scratch_root(train.sparkSession)
    model = GBTClassifier(
        featuresCol="features", labelCol=label, maxIter=n_trees, maxDepth=3, stepSize=0.05,
        subsamplingRate=0.8, seed=seed, checkpointInterval=50,
    )
    parts = 1 + train.count() // ROWS_PER_TASK
    return Pipeline(stages=[model]).fit(assemble(train.select(label, *columns), columns).select(label, "features").coalesce(parts))


_NODE = re.compile(r"^(\s*)(If|Else) \(feature (\d+) (<=|>) (\S+)\)$|^(\s*)Predict: (\S+)$")


def trees(model: PipelineModel) -> list[tuple[float, list]]:
    """Weight and nodes of each boosted tree: ``[feature, threshold, left, right]``, or ``[value]`` for a leaf."""
    boosted = model.stages[-1]
    out = []
    for tree, weight in zip(boosted.trees, boosted.treeWeights, strict=True):
        lines = [m for m in map(_NODE.match, tree.toDebugString.splitlines()) if m]
        node, rest = _node(lines)
        if rest:
            raise ValueError("a tree that is not understood")
        out.append((float(weight), node))
    return out


def _node(lines: list) -> tuple[list, list]:
    head = lines[0]
    if head[7] is not None:
        return [float(head[7])], lines[1:]
    if (head[2], head[4]) != ("If", "<="):
        raise ValueError("only splits of numbers")
    left, rest = _node(lines[1:])
    if rest[0][2] != "Else":
        raise ValueError("a split without its other side")
    right, rest = _node(rest[1:])
    return [int(head[3]), float(head[5]), left, right], rest


def boosted_probability(model: PipelineModel, values: Sequence[Column]) -> Column:
    """The fitted boosted trees as one column expression: nested conditions per tree, their weighted sum, and
    its logistic. Rows are scored where they are, without vectors or a call into the model."""

    def nested(node: list) -> Column:
        if len(node) == 1:
            return F.lit(node[0])
        feature, threshold, left, right = node
        return F.when(values[feature].cast("double") <= threshold, nested(left)).otherwise(nested(right))

    terms = F.array(*[nested(n) * F.lit(w) for w, n in trees(model)])
    margin = F.aggregate(terms, F.lit(0.0), lambda total, v: total + v)
    return _sigmoid(margin * 2)


def probability(model: Logistic | PipelineModel, values: Sequence[Column]) -> Column:
    """The churn probability of either model as a column over its features, in their order."""
    return model.probability(values) if isinstance(model, Logistic) else boosted_probability(model, values)


def with_probability(model: Logistic | PipelineModel, df: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """Adds ``p``, the churn probability."""
    return df.withColumn("p", probability(model, [F.col(c) for c in columns]))


def evaluate(scored: DataFrame, name: str, label: str = LABEL, score: str = "p") -> DataFrame:
    """One row of test metrics."""
    curve = score_curve(scored, score, label)
    parts = (
        roc_auc(curve).select(F.round("roc_auc", 3).alias("roc_auc")),
        average_precision(curve).select(F.round("average_precision", 3).alias("pr_auc")),
        lift(curve).select(
            F.round(F.col("top_rate") * 100, 1).alias("top20_churn_rate_pct"), F.round("lift", 2).alias("top20_lift")
        ),
    )
    return side_by_side(*parts).select(F.lit(name).alias("model"), "*")


def score_frame(labelled: DataFrame, segments: DataFrame, probability: Column) -> DataFrame:
    """Customer scores: RFM, outcome, value and the rounded probability with its band.

    ``monetary`` is the whole history; ``monetary_12m`` the trailing year.
    """
    return (
        labelled.join(segments, "customer_id")
        .withColumn("churn_probability", F.round(probability, 4))
        .select(
            "customer_id", "R", "F", "M", "segment", F.col(LABEL).cast("int").alias("churned_h2_2025"),
            "recency_days", "frequency", F.col("monetary").cast("double").alias("monetary"),
            "churn_probability", risk_band("churn_probability").alias("churn_risk"),
            F.col("monetary_12m").cast("double").alias("monetary_12m"),
        )
    )


def linear_attribution(model: Logistic, df: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """Mean absolute contribution per feature to the log-odds of the logistic model.

    For a linear model the contribution against the training mean is exactly
    weight x standardised value; one aggregate over the rows.
    """
    weights = [w / s if s else 0.0 for w, s in zip(model.weights, model.spreads, strict=True)]
    return linear_terms(df, columns, weights, model.means)


def linear_terms(df: DataFrame, columns: Sequence[str], weights: Sequence[float], means: Sequence[float]) -> DataFrame:
    """``feature, importance``: mean of |weight x (value - mean)| of a linear score."""
    terms = [
        F.avg(F.abs((F.col(c).cast("double") - float(m)) * float(w))).alias(c) for c, w, m in zip(columns, weights, means)
    ]
    return df.agg(*terms).unpivot([], list(columns), "feature", "importance")


def permutation_attribution(
    model: Logistic | PipelineModel, df: DataFrame, columns: Sequence[str] = FEATURES, label: str = LABEL, key: str = "customer_id"
) -> DataFrame:
    """Loss of AUC when one feature is shuffled, for any model.

    All rows get a position in hash order; feature j of a row moves j + 1
    positions on (cyclically), a different fixed shift per feature. One shuffle
    by target position brings the moved values together, and all variants are
    scored and ranked in one job.
    """
    columns = list(columns)
    narrow = df.select(key, label, *[F.col(c).cast("double").alias(c) for c in columns])
    placed = with_dense_key(narrow.withColumn("_hash", F.md5(key)), ["_hash", key], "_at")
    rows = placed.count()
    moves = F.array(
        *[
            F.struct(
                ((F.col("_at") - 1 + 1 + j % max(rows - 1, 1)) % rows + 1).alias("to"), F.lit(j).alias("j"), F.col(c).alias("value")
            )
            for j, c in enumerate(columns)
        ]
    )
    moved = (
        placed.select(F.explode(moves).alias("m"))
        .select("m.*")
        .groupBy(F.col("to").alias("_at"))
        .agg(*[F.max(F.when(F.col("j") == j, F.col("value"))).alias(f"_{j}") for j in range(len(columns))])
    )
    variants = [("", [F.col(c) for c in columns])]
    variants += [
        (c, [F.col(f"_{j}") if i == j else F.col(x) for i, x in enumerate(columns)]) for j, c in enumerate(columns)
    ]
    each = F.array(*[F.struct(F.lit(n).alias("feature"), F.array(*v).alias("v")) for n, v in variants])
    shuffled = placed.join(moved, "_at").select(label, F.explode(each).alias("x")).select(label, "x.feature", "x.v")
    rescored = shuffled.withColumn("p", probability(model, [F.col("v")[i] for i in range(len(columns))]))
    auc = roc_auc(score_curve(rescored, "p", label, ["feature"]), ["feature"])
    # Thirteen rows: the unshuffled AUC is the one of the empty feature name.
    whole = F.max(F.when(F.col("feature") == "", F.col("roc_auc")))
    stacked = auc.agg(whole.alias("base"), *[
        F.max(F.when(F.col("feature") == c, F.col("roc_auc"))).alias(c) for c in columns
    ])
    drops = stacked.select(*[(F.col("base") - F.col(c)).alias(c) for c in columns])
    return drops.unpivot([], columns, "feature", "importance")


def top_drivers(attribution: DataFrame, k: int = 5) -> DataFrame:
    return attribution.orderBy(F.desc("importance"), "feature").limit(k)
