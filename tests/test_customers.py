"""Cohorts, features, RFM, metrics, models."""

import datetime as dt
import json
import math
import random

import numpy as np
import pandas as pd
import pytest
from support import make_lines, make_star
from pyspark.sql import functions as F

from tillstar.functions.columns import pct_one_decimal, quartile, risk_band
from tillstar.operators import churn, cohorts, features, metrics
from tillstar.operators.fact import order_dedup, order_lines
from tillstar.plans import customers, report


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 13, 50])
def test_quartiles_are_those_of_qcut(spark, n):
    got = [r.q for r in spark.range(1, n + 1).select(quartile("id", F.lit(n)).alias("q"), "id").orderBy("id").collect()]
    want = pd.qcut(pd.Series(range(1, n + 1)), 4, labels=[1, 2, 3, 4]).astype(int).tolist() if n > 1 else [1]
    assert got == want


def test_risk_band_edges(spark):
    p = [0.0, 0.3, 0.3001, 0.6, 0.6001, 1.0]
    df = spark.createDataFrame([(x,) for x in p], "p double")
    assert [r[0] for r in df.select(risk_band("p")).collect()] == ["Low", "Low", "Medium", "Medium", "High", "High"]
    left = [r[0] for r in df.select(risk_band("p", "left")).collect()]
    assert left == ["Low", "Medium", "Medium", "High", "High", "High"]


def test_percent_is_half_up(spark):
    df = spark.createDataFrame([(1, 2000), (1, 8), (3, 3), (0, 7), (2, 3)], "a long, b long")
    assert [r[0] for r in df.select(pct_one_decimal("a", "b")).collect()] == [0.1, 12.5, 100.0, 0.0, 66.7]


def test_rfm_matches_rank_definition(spark):
    rng = random.Random(5)
    rows = [(f"c{i:03d}", rng.choice([1, 1, 2, 9]), rng.choice([1, 2, 3]), float(rng.choice([10, 20, 20, 35]))) for i in range(50)]
    got = {r.customer_id: (r.R, r.F, r.M) for r in features.rfm_scores(spark.createDataFrame(rows, "customer_id string, recency_days int, frequency int, monetary double")).collect()}
    p = pd.DataFrame(rows, columns=["id", "rec", "f", "m"]).set_index("id").sort_index()
    want = pd.DataFrame({
        "R": pd.qcut(-p.rec.rank(method="first"), 4, labels=[1, 2, 3, 4]).astype(int),
        "F": pd.qcut(p.f.rank(method="first"), 4, labels=[1, 2, 3, 4]).astype(int),
        "M": pd.qcut(p.m.rank(method="first"), 4, labels=[1, 2, 3, 4]).astype(int),
    })
    assert got == {i: tuple(r) for i, r in want.iterrows()}


def test_features_and_label_by_hand(spark):
    lines = spark.createDataFrame(
        [
            ("A", "Corporate", dt.date(2024, 1, 1), "o1", "Online", 10.0, 0.1, False, "X"),
            ("A", "Corporate", dt.date(2024, 1, 1), "o1", "Online", 20.0, 0.0, True, "Y"),
            ("A", "Corporate", dt.date(2024, 6, 30), "o2", "Store", 30.0, 0.2, False, "X"),
            ("A", "Corporate", dt.date(2024, 7, 1), "o3", "Store", 99.0, 0.2, False, "Z"),
            ("B", "Consumer", dt.date(2022, 1, 1), "o4", "Store", 5.0, 0.0, False, "X"),
        ],
        "customer_id string, segment string, order_date date, order_id string, channel string, net_revenue double, "
        "discount_pct double, is_returned boolean, category string",
    ).withColumn("net_revenue", F.col("net_revenue").cast("decimal(18,2)")).withColumn("discount_pct", F.col("discount_pct").cast("decimal(5,4)"))
    found = {r.customer_id: r for r in features.customer_features(lines, "2024-06-30").collect()}
    a = found["A"]
    assert (a.recency_days, a.tenure_days, a.frequency, float(a.monetary)) == (0, 181, 2, 60.0)
    assert a.avg_order_value == 30 and a.avg_discount == pytest.approx(0.1) and a.online_share == 0.5
    assert a.n_categories == 2 and a.return_rate == pytest.approx(1 / 3) and a.orders_last_90d == 1
    assert a.is_corporate == 1 and a.orders_per_month == pytest.approx(2 / (181 / 30))
    b = found["B"]
    assert b.is_corporate == 0 and b.orders_last_90d == 0 and float(b.monetary_12m) == 0
    active = features.active_customers(features.customer_features(lines, "2024-06-30"))
    assert [r.customer_id for r in active.collect()] == ["A"]
    label = features.churn_label(lines, active, "2024-06-30", "2024-12-31").first()
    assert label.churned == 0
    assert features.churn_label(lines, active, "2024-07-01", "2024-12-31").first().churned == 1


def curve_of(spark, rows):
    return metrics.score_curve(spark.createDataFrame(rows, "p double, y int"), "p", "y")


def brute_auc(rows):
    pos, neg = [p for p, y in rows if y], [p for p, y in rows if not y]
    return sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))


def brute_ap(rows):
    total, area, seen = sum(y for _, y in rows), 0.0, 0.0
    for t in sorted({p for p, _ in rows}, reverse=True):
        top = [y for p, y in rows if p >= t]
        area += (sum(top) / total - seen) * (sum(top) / len(top))
        seen = sum(top) / total
    return area


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_metrics_against_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = [(round(rng.random(), 1 if seed == 1 else 3), int(rng.random() < 0.4)) for _ in range(211)]
    curve = curve_of(spark, rows)
    assert metrics.roc_auc(curve).first()[0] == pytest.approx(brute_auc(rows))
    assert metrics.average_precision(curve).first()[0] == pytest.approx(brute_ap(rows))
    for q in (0.0, 0.25, 0.8, 1.0):
        assert metrics.quantile(curve, q).first()[0] == pytest.approx(np.quantile([p for p, _ in rows], q))
    t = np.quantile([p for p, _ in rows], 0.8)
    top = [y for p, y in rows if p >= t]
    got = metrics.lift(curve).first()
    assert got.top_customers == len(top) and got.top_rate == pytest.approx(np.mean(top))


def test_grouped_auc_and_one_class(spark):
    rng = random.Random(9)
    rows = [(g, round(rng.random(), 1), int(rng.random() < 0.5)) for g in ("a", "b", "c") for _ in range(60)]
    df = spark.createDataFrame(rows, "g string, p double, y int")
    got = {r.g: r.roc_auc for r in metrics.roc_auc(metrics.score_curve(df, "p", "y", ["g"]), ["g"]).collect()}
    assert got == pytest.approx({g: brute_auc([(p, y) for k, p, y in rows if k == g]) for g in ("a", "b", "c")})
    assert metrics.roc_auc(curve_of(spark, [(0.1, 1), (0.2, 1)])).first()[0] is None


def test_cohorts(spark):
    rows = [("A", "2023-01-05"), ("A", "2023-02-05"), ("A", "2023-02-20"), ("B", "2023-03-31"), ("B", "2023-04-01"), ("C", "2023-03-02"),
            ("D", "2024-06-01")]
    orders = spark.createDataFrame([(c, dt.date.fromisoformat(d)) for c, d in rows], "customer_id string, order_date date")
    got = {(r.cohort, r.months_since_first): r.retention_pct for r in cohorts.cohort_retention(orders, "2024-12-31").collect()}
    assert got == {("2023Q1", 0): 100.0, ("2023Q1", 1): 66.7}  # the 2024 cohort is too young
    table = cohorts.cohort_retention(orders, "2024-12-31")
    matrix = cohorts.cohort_pivot(table)
    assert matrix.columns == ["cohort", *[f"m{i}" for i in range(13)]]
    back = {(r.cohort, r.months_since_first): r.retention_pct for r in cohorts.cohort_unpivot(matrix).collect()}
    assert back == got


@pytest.fixture(scope="module")
def shop(spark):
    """Customers whose buying rate falls with their number: recency tells churn."""
    rng = random.Random(11)
    lines = []
    for c in range(240):
        gap = 15 + c // 2
        day = dt.date(2023, 1, 1) + dt.timedelta(rng.randrange(gap))
        while day <= dt.date(2024, 12, 31):
            lines.append({"customer_id": f"C{c:03d}", "order_id": f"{c}-{day}", "order_date": day, "unit_price": rng.randrange(5, 90),
                          "channel": rng.choice(["Online", "Store"]), "category": rng.choice("XYZ"), "sku": "K" + rng.choice("123"),
                          "is_returned": rng.random() < 0.1})
            day += dt.timedelta(1 + int(gap * (0.5 + rng.random()) * (3 if rng.random() < c / 600 else 1)))
    return make_star(make_lines(spark, lines))


def test_full_run(spark, shop, tmp_path):
    res = customers.run(shop, "2024-06-30", "2024-12-31", n_trees=10, folder=str(tmp_path))
    m = {r.model: r for r in res.metrics.collect()}
    assert set(m) == {"logistic_regression", "gradient_boosting"}
    assert m["logistic_regression"].roc_auc > 0.75 and m["gradient_boosting"].roc_auc > 0.7
    assert m["gradient_boosting"].top20_lift > 1
    month0 = res.base.cohorts.filter("months_since_first = 0").select("retention_pct").distinct().collect()
    assert [r[0] for r in month0] == [100.0]
    scores = res.scores.collect()
    assert len(scores) == res.base.labelled.count()
    assert all(0 <= r.churn_probability <= 1 and r.churn_risk in ("Low", "Medium", "High") for r in scores)
    drivers = {r.feature: r.importance for r in res.drivers.collect()}
    assert set(drivers) == set(features.FEATURES) and max(drivers.values()) > 0
    summary = res.summary.first()
    assert summary.n_customers == len(scores) and len(summary.models) == 2 and len(summary.top_drivers) == 5
    parts = [p for p in (tmp_path / "customer_analytics.json").iterdir() if p.suffix == ".json"]
    assert json.loads(parts[0].read_text())["test_size"] == summary.test_size
    assert (tmp_path / "customer_scores").exists() and (tmp_path / "cohort_retention").exists()
    assert report.report("churn_kpis", scores=res.scores).first().customers_scored == len(scores)
    assert [r.churn_risk for r in report.report("risk_bands", scores=res.scores).collect()] == [
        b for b in ("High", "Medium", "Low") if any(s.churn_risk == b for s in scores)
    ]


def test_split_is_stratified_and_repeatable(spark, shop):
    lines = order_lines(shop)
    base = features.churn_label(lines, features.customer_features(lines, "2024-06-30"), "2024-06-30", "2024-12-31")
    first = churn.train_test_split(base)
    sizes = {(r.churned, r.is_test): r["count"] for r in first.groupBy("churned", "is_test").count().collect()}
    for y in (0, 1):
        n = sizes[(y, True)] + sizes[(y, False)]
        assert sizes[(y, True)] == int(n * 0.25 + 0.5)
    again = churn.train_test_split(base.repartition(3))
    assert {r.customer_id for r in again.filter("is_test").collect()} == {r.customer_id for r in first.filter("is_test").collect()}
    assert order_dedup(lines).count() == lines.select("order_id").distinct().count()


@pytest.fixture(scope="module")
def training(spark):
    rnd = random.Random(13)
    rows = []
    for i in range(900):
        x = [rnd.gauss(50, 20), rnd.choice([0.0, 1.0, 2.5]), rnd.random(), 7.0]
        z = 0.05 * (x[0] - 50) + x[1] - 2 * x[2]
        rows.append((int(rnd.random() < 1 / (1 + math.exp(-z))), *x))
    return spark.createDataFrame(rows, f"{churn.LABEL} int, a double, b double, c double, same double").repartition(3)


COLUMNS = ("a", "b", "c", "same")


def test_newton_steps_reach_the_optimum(training):
    """The plain solver's weights and those of Spark ML; a constant feature stays out."""
    import numpy as np
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import StandardScaler

    model = churn.fit_logistic(training, columns=COLUMNS)
    table = training.toPandas()
    x, y = table[list(COLUMNS)].to_numpy(), table[churn.LABEL].to_numpy().astype(float)
    spread = x.std(axis=0, ddof=1)
    x = np.hstack([np.ones((len(x), 1)), np.where(spread > 0, (x - x.mean(axis=0)) / np.where(spread > 0, spread, 1), 0)])
    beta, penalty = np.zeros(5), np.diag([0.0, 1, 1, 1, 1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-x @ beta))
        beta -= np.linalg.solve(x.T * (p * (1 - p)) @ x + penalty, x.T @ (p - y) + penalty @ beta)
    assert np.allclose([model.intercept, *model.weights], beta, atol=1e-8)
    frame = churn.assemble(training, COLUMNS)
    scaled = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True).fit(frame).transform(frame)
    fitted = LogisticRegression(featuresCol="scaled", labelCol=churn.LABEL, regParam=1 / 900, standardization=False, maxIter=1000, tol=1e-12).fit(scaled)
    assert np.allclose([fitted.intercept, *fitted.coefficients], beta, atol=1e-6)
    assert churn.fit_logistic(training.repartition(7), columns=COLUMNS).weights == pytest.approx(model.weights, abs=1e-12)


def test_compiled_trees_are_the_model(training):
    from pyspark.ml.functions import vector_to_array

    model = churn.fit_gbt(training, n_trees=12, columns=COLUMNS)
    scored = churn.with_probability(model, training, COLUMNS)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "UDF" not in plan and "vector" not in plan.lower()
    both = model.transform(churn.assemble(scored, COLUMNS)).select("p", vector_to_array("probability")[1].alias("q")).collect()
    assert len(both) == 900 and max(abs(r.p - r.q) for r in both) < 1e-12
    assert len({round(r.p, 6) for r in both}) > 10
