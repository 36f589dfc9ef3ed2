"""Two-stage measures under items, filter contexts, mergeable distinct counts, activity masks and sketches."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from support import make_lines, make_star

from tillstar.operators import calcitems, cohorts, distincts, metrics, rollups
from tillstar.operators.context import Context, evaluate, shares
from tillstar.operators.measures import measure
from tillstar.operators.timeintel import CALC_GROUP
from tillstar.star import Star

CITIES = {"Pune": ("MH", "India"), "Thane": ("MH", "India"), "Delhi": ("DL", "India"), "Lyon": ("RA", "France")}
BOUNDS = (dt.date(2022, 1, 1), dt.date(2024, 12, 31))


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(9)
    out = []
    for i in range(500):
        city = rnd.choice(list(CITIES))
        day = dt.date(2022, 1, 1) + dt.timedelta(rnd.choice([rnd.randrange(200), rnd.randrange(1096)]))
        category = rnd.choice(["Office", "Food", "Toys", "Garden"])
        out.append(
            {
                "order_id": f"SO-{i // 2 if rnd.random() < 0.5 else i}", "order_date": day, "customer_id": f"C{rnd.randrange(30)}", "city": city,
                "state": CITIES[city][0], "country": CITIES[city][1], "store_name": f"S-{city}", "category": category,
                "sku": f"K-{category}-{rnd.randrange(3)}", "product_name": f"{category}{rnd.randrange(2)}",
                "unit_price": rnd.choice([10, 20, 20, 35]), "quantity": rnd.randrange(1, 4), "is_returned": rnd.random() < 0.15,
            }
        )
    # Members that are the smallest of the calendar's ends.
    out += [{"order_date": dt.date(2022, 1, 1), "sku": "K-Z", "category": "Zero", "is_returned": True}, {"order_date": dt.date(2024, 12, 31)}]
    return out


@pytest.fixture(scope="module")
def star(spark, rows):
    return make_star(make_lines(spark, rows))


@pytest.fixture(scope="module")
def facts(star):
    named = star.sales("category", "country", "state", "city", "store_name", "segment")
    return [r.asDict() for r in named.collect()]


def month(key):
    return key // 10000 * 12 + key // 100 % 100 - 1


def span(item, last, size):
    """First and last month an item covers for a period that ends with month ``last``."""
    return {
        "Current": (last - size + 1, last), "PY": (last - size - 11, last - 12), "MTD": (last, last), "QTD": (last - last % 3, last),
        "YTD": (last - last % 12, last), "FYTD": (last - (last - 3) % 12, last),
    }[item]


def revenue(facts, item, last, size, test):
    lo, hi = span(item, last, size)
    found = [f["net_revenue"] for f in facts if not f["is_returned"] and lo <= month(f["date_key"]) <= hi and test(f)]
    return sum(found) if found else None


def derived(values):
    now, before = values["Current"], values["PY"]
    values["YoY"] = None if now is None and before is None else (now or 0) - (before or 0)
    values["YoY %"] = None if not before else ((now or 0) - before) / before
    return values


def quarter_of(last):
    return f"{last // 12}Q{last % 12 // 3 + 1}"


QUARTERS = [2022 * 12 + 2 + 3 * q for q in range(12)]


def same_items(found, keys, want):
    got = {(*[r[k] for k in keys], r["period"], r["calc"]): r["value"] for r in found.collect()}
    want = {k: float(v) for k, v in want.items() if v is not None}
    assert got == pytest.approx(want)
    ordinals = {(r["calc"], r["ordinal"]) for r in found.select("calc", "ordinal").distinct().collect()}
    assert ordinals <= set(zip(CALC_GROUP, range(8), strict=True))


def ranks(values):
    order = sorted({v or 0 for v in values.values()}, reverse=True)
    return {k: order.index(v or 0) + 1 for k, v in values.items()}


@pytest.mark.parametrize("top", [None, 2])
def test_rank_and_top_n_under_items(star, facts, top):
    want = {}
    members = ["Office", "Food", "Toys", "Garden", "Zero"]
    for last in QUARTERS:
        per = {c: {} for c in members}
        for item in calcitems.PLAIN:
            values = {c: revenue(facts, item, last, 3, lambda f, c=c: f["category"] == c) for c in members}
            for c, r in ranks(values).items():
                per[c][item] = r if top is None else values[c] if r <= top else None
        for c, values in per.items():
            values = {k: None if v is None else float(v) for k, v in values.items()}
            want |= {(c, quarter_of(last), k): v for k, v in derived(values).items()}
    name = "category_rank" if top is None else "top_n_revenue"
    found = calcitems.calc_any(name, BOUNDS, ["category"], star, grain="quarter", top=top)
    assert found.columns == ["period", "category", "calc", "ordinal", "value"]
    same_items(found, ["category"], want)


def test_rank_within_a_selection(star, facts):
    found = calcitems.calc_rank(star, BOUNDS, "city", grain="quarter", members=F.col("country") == "India")
    want = {}
    for last in QUARTERS:
        per = {c: {} for c in ("Pune", "Thane", "Delhi")}
        for item in calcitems.PLAIN:
            values = {c: revenue(facts, item, last, 3, lambda f, c=c: f["city"] == c) for c in per}
            for c, r in ranks(values).items():
                per[c][item] = float(r)
        for c, values in per.items():
            want |= {(c, quarter_of(last), k): v for k, v in derived(values).items()}
    same_items(found, ["city"], want)


def test_share_of_parent_under_items(star, facts):
    levels = ["country", "state", "city"]
    paths = {tuple(f[c] for c in levels) for f in facts}
    want = {}
    for last in QUARTERS:
        for n in range(4):
            for path in {p[:n] for p in paths}:
                values = {}
                for item in calcitems.PLAIN:
                    mine = revenue(facts, item, last, 3, lambda f, p=path: tuple(f[c] for c in levels[: len(p)]) == p)
                    up = revenue(facts, item, last, 3, lambda f, p=path[:-1]: tuple(f[c] for c in levels[: len(p)]) == p)
                    values[item] = None if mine is None else float(mine / up)
                shown = (*path, *[None] * (3 - n))
                want |= {(n, *shown, quarter_of(last), k): v for k, v in derived(values).items()}
    same_items(calcitems.calc_share_of_parent(star, BOUNDS, levels, "quarter"), ["level", *levels], want)


def test_measures_without_a_calendar_keep_their_value(spark):
    scores = spark.createDataFrame([("A", "High", 0.9, 1, 10.0), ("A", "Low", 0.1, 0, 5.0), ("B", "Low", 0.2, 0, 7.0)],
                                   "segment string, churn_risk string, churn_probability double, churned_h2_2025 int, monetary double")
    found = calcitems.calc_any("high_risk_pct", BOUNDS, ["segment"], scores=scores, grain="year").collect()
    want = {("A", str(y), c): 0.0 if c in ("YoY", "YoY %") else 0.5 for y in (2022, 2023, 2024) for c in CALC_GROUP}
    assert {(r["segment"], r["period"], r["calc"]): r["value"] for r in found} == want
    with pytest.raises(ValueError):
        calcitems.calc_any("no such", BOUNDS)


def test_any_base_measure_goes_through(star):
    a = calcitems.calc_any("orders", BOUNDS, ["country"], star, grain="year").collect()
    assert {r["calc"] for r in a} == set(CALC_GROUP)


# ---------------------------------------------------------------- filter contexts


def test_operations_on_a_context(star, facts):
    y = lambda n: F.floor(F.col("date_key") / 10000) == n
    base = Context().select("year", F.col("year") == 2023).select("country", F.col("country") == "India")
    cells = {
        "here": ("total_revenue", base),
        "replaced": ("total_revenue", base.where("year", F.col("year") == 2022)),
        "kept": ("total_revenue", base.keep("date_key", F.col("date_key") < 20230701)),
        "contradiction": ("total_revenue", base.keep("date_key", y(2022))),
        "all_cities": ("total_revenue", base.all("city")),
        "all_countries": ("total_revenue", base.all("city", "country")),
        "selected": ("total_revenue", base.where("country", F.col("country") == "France").all_selected("city", "country")),
        "one_city": ("total_revenue", base.where("city", F.col("city") == "Pune")),
        "ever": ("orders", base.remove(star.dim_date)),
        "customers": ("active_customers", base),
        "aov": ("avg_order_value", base),
    }
    got = {r["city"]: r.asDict() for r in evaluate(star, cells, ["city"]).collect()}

    def total(test):
        found = [f["net_revenue"] for f in facts if not f["is_returned"] and test(f)]
        return sum(found) if found else None

    in_year = lambda f, n=2023: f["date_key"] // 10000 == n
    india = lambda f: f["country"] == "India"
    assert set(got) == set(CITIES)
    for city, r in got.items():
        mine = lambda f, c=city: f["city"] == c
        assert r["here"] == total(lambda f: mine(f) and india(f) and in_year(f))
        assert r["replaced"] == total(lambda f: mine(f) and india(f) and in_year(f, 2022))
        assert r["kept"] == total(lambda f: mine(f) and india(f) and in_year(f) and f["date_key"] < 20230701)
        assert r["contradiction"] is None
        assert r["all_cities"] == r["selected"] == total(lambda f: india(f) and in_year(f))
        assert r["all_countries"] == total(in_year)
        assert r["one_city"] == total(lambda f: f["city"] == "Pune" and in_year(f))
        assert r["ever"] == (len({f["order_id"] for f in facts if mine(f) and india(f) and not f["is_returned"]}) or None)
        some = [f for f in facts if mine(f) and india(f) and in_year(f) and not f["is_returned"]]
        assert r["customers"] == (len({f["customer_key"] for f in some}) or None)
        assert r["aov"] == (pytest.approx(float(r["here"]) / len({f["order_id"] for f in some})) if some else None)


def test_contexts_agree_with_plain_measures(star):
    cells = {n: (n, Context()) for n in ("total_revenue", "orders", "active_customers", "gross_margin_pct", "return_rate_pct")}
    a = evaluate(star, cells, ["category", "segment"])
    b = measure(star, list(cells), ["category", "segment"])
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.select(a.columns).collect()), key=repr)
    none = evaluate(star, {"r": ("total_revenue", Context().where("year", F.lit(False))), "o": ("orders", Context().where("year", F.lit(False)))})
    assert [tuple(r) for r in none.collect()] == [(None, None)]
    with pytest.raises(ValueError):
        evaluate(star, {})


def test_contexts_read_the_facts_once(star, spark, tmp_path):
    """Every cell's plan starts from the marked rows, none from the facts."""
    out = shares(star, ["country", "city"])
    fact = set(star.fact_sales.inputFiles())
    assert fact and not fact & set(out.inputFiles())


# ---------------------------------------------------------------- distinct counts


def distinct_counts(facts, keys, test=lambda f: True):
    found = defaultdict(lambda: (set(), set()))
    for f in facts:
        if not f["is_returned"] and test(f):
            k = tuple(f[c] for c in keys)
            found[k][0].add(f["order_id"])
            found[k][1].add(f["customer_key"])
    return {k: (len(a), len(b)) for k, (a, b) in found.items()}


@pytest.mark.parametrize("bucket_rows", [5, 1 << 14])
def test_cube(star, facts, monkeypatch, bucket_rows):
    monkeypatch.setattr(distincts, "BUCKET_ROWS", bucket_rows)
    cube = distincts.DistinctCube.build(star, ["country", "category"])
    year = F.floor(F.col("month") / 100).cast("int").alias("year")
    rows = [f | {"year": f["date_key"] // 10000} for f in facts]
    assert {tuple(r)[:2]: tuple(r)[2:] for r in cube.count(["category", year]).collect()} == distinct_counts(rows, ["category", "year"])
    assert [tuple(r) for r in cube.count().collect()] == [*distinct_counts(rows, []).values()]
    spring = cube.count(["country"], F.col("month").between(202303, 202305))
    assert {(r["country"],): (r["orders"], r["active_customers"]) for r in spring.collect()} == distinct_counts(
        rows, ["country"], lambda f: 20230301 <= f["date_key"] <= 20230531)
    want = {}
    for at in range(2022 * 12, 2025 * 12):
        per = distinct_counts(rows, ["country"], lambda f, at=at: at - 4 < month(f["date_key"]) <= at)
        want |= {(*k, at // 12 * 100 + at % 12 + 1): v for k, v in per.items()}
    assert {tuple(r)[:2]: tuple(r)[2:] for r in cube.trailing(["country"], 4).collect()} == want


def test_bitmaps_of_hashed_identifiers(spark, monkeypatch):
    """More identifiers than a word and a bucket hold; nulls and repeated rows."""
    monkeypatch.setattr(distincts, "BUCKET_ROWS", 300)
    rows = spark.range(4000).select((F.col("id") % 7).alias("k"), F.concat(F.lit("SO-"), F.col("id") % 1777).alias("o"), (F.col("id") % 501 + 1).alias("c"))
    rows = rows.unionAll(rows).unionAll(spark.sql("SELECT 3L, NULL, NULL"))
    sets = distincts.bitmaps(rows, ["k"], {"orders": "o", "customers": "c"}, 4000)
    got = distincts.counted(distincts.merged(sets, ["k"]), ["k"], ["orders", "customers"])
    want = rows.groupBy("k").agg(F.countDistinct("o").alias("_orders"), F.countDistinct("c").alias("_customers"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    whole = distincts.counted(distincts.merged(sets, []), [], ["orders", "customers"]).first()
    assert tuple(whole) == (1777, 501)


def test_hierarchy_expands_members_only(star, facts):
    """Identifiers are marked, not expanded: the one Expand is above the last aggregate per member."""
    levels = ["country", "state", "city"]
    found = rollups.hierarchy(star, levels, ["total_revenue", "orders", "active_customers"])
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Expand") == 1 and "count(distinct" not in plan and plan.index("Expand") < plan.index("Window")
    got = {(r["level"], r["country"], r["state"], r["city"]): (r["orders"], r["active_customers"]) for r in found.collect()}
    want = {}
    for n in range(4):
        for k, v in distinct_counts(facts, levels[:n]).items():
            want[(n, *k, *[None] * (3 - n))] = v
    assert got == want


def test_sketches_stay_within_their_error(spark, star):
    days = spark.range(60_000).select(
        F.col("id").alias("customer_key"), (F.col("id") % 28 + 20230101).cast("int").alias("date_key"), (F.col("id") % 10 == 0).alias("is_returned"),
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("kind"),
    )
    many = Star(**{**star.dims(), "fact_sales": days.unionAll(days.withColumn("date_key", F.col("date_key") + 1))})
    sketches = distincts.customer_sketches(many, ["kind"])
    assert sketches.count() == 2 * 29
    got = {r["kind"]: r["active_customers"] for r in distincts.approx_active_customers(sketches, ["kind"]).collect()}
    assert got["a"] == pytest.approx(18_000, rel=0.06) and got["b"] == pytest.approx(36_000, rel=0.06)
    half = distincts.approx_active_customers(sketches, [], F.col("date_key") <= 20230110).first()
    assert half["active_customers"] == pytest.approx(60_000 * 0.9 * 10 / 28, rel=0.06)


def test_sketched_quantile(spark):
    scores = spark.range(50_000).select((F.col("id") % 4).alias("part"), (F.col("id") / 50_000).alias("score"))
    parts = metrics.quantile_sketches(scores, "score", ["part"])
    assert parts.count() == 4
    assert abs(metrics.sketched_quantile(parts, 0.8).first()["threshold"] - 0.8) < 0.03
    assert metrics.sketched_quantile(parts, 0.5, ["part"]).count() == 4


# ---------------------------------------------------------------- activity masks


def test_activity_masks_over_many_months(spark):
    rnd = random.Random(11)
    rows, want = [], {}
    for c in range(60):
        first = rnd.randrange(0, 190)
        months = sorted({first, *[min(199, first + rnd.choice([1, 2, 5, 12, 40, 59, 60, 90])) for _ in range(rnd.randrange(4))]})
        rows += [(f"C{c}", dt.date(2000 + m // 12, m % 12 + 1, rnd.randrange(1, 29))) for m in months for _ in range(rnd.randrange(1, 3))]
        want[f"C{c}"] = (dt.date(2000 + first // 12, first % 12 + 1, 1), sum(1 << (m - first) for m in months if m - first < 60))
    orders = spark.createDataFrame(rows, "customer_id string, order_date date")
    for bounds in ({}, {"since": dt.date(1999, 3, 9), "until": dt.date(2017, 1, 1)}):
        got = cohorts.activity_masks(orders, **bounds)
        assert {r["customer_id"]: (r["cohort_month"], r["ages"]) for r in got.collect()} == want
    assert cohorts.activity_masks(orders.where("false")).count() == 0
    plan = cohorts.cohort_retention(orders, "2016-12-31", since=dt.date(2000, 1, 1), until=dt.date(2017, 1, 1))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Window" not in plan
