"""Measures, ranks, hierarchies, security, report tables."""

import pytest
from support import make_lines, make_star
from pyspark.sql import functions as F

from tillstar.operators import measures, ranking, rollups, security
from tillstar.operators.fact import in_period
from tillstar.plans.kpi import kpi_table
from tillstar.sources.files import security_map


@pytest.fixture(scope="module")
def star(spark):
    rows = [
        {"order_id": "1", "customer_id": "A", "category": "X", "sku": "1", "unit_price": 100, "discount_pct": 0.1},
        {"order_id": "1", "customer_id": "A", "category": "Y", "sku": "2", "unit_price": 50, "is_returned": True},
        {"order_id": "2", "customer_id": "A", "category": "X", "sku": "1", "unit_price": 100, "order_date": "2024-03-01"},
        {"order_id": "3", "customer_id": "B", "category": "Y", "sku": "2", "unit_price": 80, "is_returned": True,
         "order_date": "2024-03-02", "segment": "Corporate"},
        {"order_id": "4", "customer_id": "C", "category": "Z", "sku": "3", "unit_price": 30, "quantity": 2,
         "order_date": "2025-01-02", "country": "UAE", "state": "DU", "city": "Dubai", "channel": "Online"},
    ]
    return make_star(make_lines(spark, rows))


def one(df):
    return df.first().asDict()


def test_every_measure_on_the_total(star):
    got = one(measures.measure(star, list(measures.MEASURES)))
    got = {k: float(v) for k, v in got.items()}
    assert got["total_revenue"] == 90 + 100 + 60 and got["total_cost"] == 60 + 60 + 120
    assert got["gross_margin"] == 10 and got["gross_margin_pct"] == 10 / 250
    assert got["orders"] == 3 and got["units_sold"] == 4 and got["active_customers"] == 2
    assert got["avg_order_value"] == 250 / 3 and got["revenue_per_customer"] == 125
    assert got["return_rate_pct"] == 2 / 5
    assert got["discount_pct"] == 10 / (10 + 380)


def test_returned_everything_is_blank(star):
    rows = {r.customer_id: r for r in measures.measure(star, list(measures.MEASURES), ["customer_id"]).collect()}
    b = rows["B"]
    assert [b.total_revenue, b.orders, b.active_customers, b.gross_margin, b.avg_order_value] == [None] * 5
    assert b.return_rate_pct == 1


def test_late_customer_join_agrees_with_the_plain_way(star):
    late = measures.measure(star, ["total_revenue", "discount_pct"], ["segment", "channel"])
    plain = measures.aggregate(star.sales("segment", "channel"), ["total_revenue", "discount_pct"], ["segment", "channel"])
    assert sorted(map(str, late.collect())) == sorted(map(str, plain.collect()))


def test_where_and_period(star):
    got = measures.measure(star, "total_revenue", where=F.col("country") == "India", touching=["country"])
    assert float(got.first()[0]) == 190
    assert float(measures.measure(star, "total_revenue", period=lambda f: in_period(f, year=2025)).first()[0]) == 60


def test_empty_frame_is_blank(star):
    got = one(measures.measure(star, list(measures.MEASURES), where=F.lit(False)))
    assert set(got.values()) == {None}


def test_user_defined_measure(star):
    measures.register_measure("revenue_per_unit", ["revenue", "units"], lambda b: measures.ratio(b["revenue"], b["units"]))
    try:
        assert measures.measure(star, "revenue_per_unit").first()[0] == 250 / 4
    finally:
        del measures.MEASURES["revenue_per_unit"]
    with pytest.raises(ValueError):
        measures.register_measure("x", ["nothing"], lambda b: b)


def test_new_customers_count_first_purchase_returns_included(star):
    year = F.floor(F.col("date_key") / 10000)
    got = {r.period: r.new_customers for r in measures.new_customers(star.fact_sales, year).collect()}
    assert got == {2024: 2, 2025: 1}


def test_yoy(star):
    got = one(measures.conditional_agg_yoy(star, 2025))
    assert got["yoy_pct"] == 60 / 190 - 1
    assert one(measures.conditional_agg_yoy(star, 2024))["yoy_pct"] is None


def test_rank_includes_members_without_sales(star):
    got = {r.category: (r.revenue, r.rank) for r in ranking.rank_by(star, "category", period=lambda f: in_period(f, year=2024)).collect()}
    assert got["X"][1] == 1 and got["Y"] == (None, 2) and got["Z"] == (None, 2)


def test_city_rank_within_the_selection(star):
    got = ranking.rank_by(star, "city", members=F.col("country") == "UAE").collect()
    assert [(r.city, r.rank) for r in got] == [("Dubai", 1)]


def test_city_rank_counts_only_the_selected_country(spark):
    lines = [
        {"order_id": "1", "city": "Pune", "country": "India", "unit_price": 100},
        {"order_id": "2", "city": "Pune", "country": "UAE", "unit_price": 900},
        {"order_id": "3", "city": "Delhi", "country": "India", "unit_price": 300},
    ]
    two = make_star(make_lines(spark, lines))
    got = {r.city: (float(r.revenue), r.rank) for r in ranking.rank_by(two, "city", members=F.col("country") == "India").collect()}
    assert got == {"Delhi": (300, 1), "Pune": (100, 2)}


def test_top_n(star):
    rows = {r.category: r.top_n_revenue for r in ranking.top_n(star, 1).collect()}
    assert float(rows["X"]) == 190 and rows["Z"] is None and float(rows[None]) == 250
    assert ranking.top_n_value() == 5
    with pytest.raises(ValueError):
        ranking.top_n_value(11)
    assert ranking.top_category(star).first().category == "X"
    assert [r.category for r in ranking.revenue_by(star, "category").collect()] == ["X", "Z"]


def test_hierarchy_levels_and_shares(star):
    levels = rollups.GEOGRAPHY
    frame = rollups.hierarchy(star, levels, ["total_revenue", "orders"])
    rows = frame.collect()
    assert sorted(r.level for r in rows) == [0, 1, 1, 2, 2, 3, 3, 4, 4]
    total = next(r for r in rows if r.level == 0)
    assert float(total.total_revenue) == 250 and total.orders == 3
    shared = ranking.with_share_of_parent(frame, levels).collect()
    assert {r.share_of_parent for r in shared if r.level != 1} == {1.0}
    assert sum(r.share_of_parent for r in shared if r.level == 1) == pytest.approx(1)


def test_calendar_hierarchy_does_not_clash_with_the_partition_column(star):
    frame = rollups.hierarchy(star, rollups.CALENDAR, ["total_revenue"])
    assert frame.filter("level = 1").count() == 2


def test_row_level_security(spark, star):
    mapping = security_map(spark, [("m", "UAE"), ("m", "UAE"), ("h", "UAE"), ("h", "India")])

    def revenue(s):
        return measures.measure(s, "total_revenue").first()[0]

    assert float(revenue(security.secure_static(star, "UAE"))) == 60
    assert float(revenue(security.secure_user(star, mapping, "m"))) == 60
    assert float(revenue(security.secure_user(star, mapping, "h"))) == 250
    assert revenue(security.secure_user(star, mapping, "nobody")) is None
    scores = spark.createDataFrame([("A",), ("C",)], "customer_id string")
    seen = security.secure_customers(scores, security.secure_user(star, mapping, "m"))
    assert [r.customer_id for r in seen.collect()] == ["C"]


def test_kpi_table(star):
    rows = {(r.measure, r.context): r.text for r in kpi_table(star, 2025, "India").collect()}
    assert len(rows) == 12
    assert rows[("Total Revenue", "year = 2025")] == "₹ 60"
    assert rows[("Revenue YoY %", "year = 2025")] == "-68.4%"
    assert rows[("Return Rate %", "year = 2025")] == "0.00%"
    assert rows[("Orders", "year = 2025")] == "1"
    assert rows[("Category Rank = 1", "year = 2025")] == "Z"
    assert rows[("Total Revenue (RLS: India Only)", "year = 2025")] is None
