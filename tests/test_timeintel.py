"""Calculation items against a direct evaluation of their definitions."""

import calendar
import datetime as dt
import random

import pytest
from support import make_lines, make_star

from tillstar.operators.timeintel import CALC_GROUP, calc_group, time_calc

ITEMS = ("Current", "PY", "PM", "YoY", "YoY %", "MoM %", "MTD", "QTD", "YTD", "FYTD", "Running Total", "3M Total", "3M Avg")


def add_months(d, n):
    m = d.year * 12 + d.month - 1 + n
    y, m = divmod(m, 12)
    return dt.date(y, m + 1, min(d.day, calendar.monthrange(y, m + 1)[1]))


def is_month_end(d):
    return (d + dt.timedelta(1)).month != d.month


def month_end(d):
    return dt.date(d.year, d.month, calendar.monthrange(d.year, d.month)[1])


def fiscal_year(d):
    return d.year + (d.month >= 4)


LABEL = {
    "day": lambda d: d.isoformat(),
    "month": lambda d: f"{d:%Y-%m}",
    "quarter": lambda d: f"{d.year}Q{(d.month + 2) // 3}",
    "year": lambda d: str(d.year),
    "fiscal_year": lambda d: str(fiscal_year(d)),
}


def range_of(item, days, daily):
    """First and last date an item evaluates the measure over, for a context of days."""
    first, last = min(days), max(days)
    if item == "Current":
        return first, last
    if item in ("PY", "PM"):
        n = -12 if item == "PY" else -1
        if daily:
            return (add_months(last, n),) * 2
        return add_months(first.replace(day=1), n), month_end(add_months(last.replace(day=1), n))
    if item == "3M Total":
        start = add_months(last, -3)
        start = month_end(start) if is_month_end(last) else start
        return start + dt.timedelta(1), last
    return {
        "MTD": last.replace(day=1),
        "QTD": dt.date(last.year, (last.month - 1) // 3 * 3 + 1, 1),
        "YTD": dt.date(last.year, 1, 1),
        "FYTD": dt.date(fiscal_year(last) - 1, 4, 1),
        "Running Total": dt.date(1900, 1, 1),
    }[item], last


def value(measure, rows):
    kept = [r for r in rows if not r[4]]
    revenue = sum(r[3] for r in kept) if kept else None
    orders = len({r[1] for r in kept}) or None
    customers = len({r[2] for r in kept}) or None
    if measure == "total_revenue":
        return revenue
    if measure == "orders":
        return orders
    if measure == "active_customers":
        return customers
    if measure == "avg_order_value":
        return revenue / orders if orders else None
    return sum(r[4] for r in rows) / len(rows) if rows else None  # return rate


def expected(measure, rows, cal, grain, item):
    """{period: value} by brute force."""
    contexts = {}
    for d in cal:
        contexts.setdefault(LABEL[grain](d), []).append(d)
    out = {}
    for label, days in contexts.items():
        def at(i, days=days):
            lo, hi = range_of(i, days, grain == "day")
            return value(measure, [r for r in rows if lo <= r[0] <= hi])

        cur, py, pm = (at(i) for i in ("Current", "PY", "PM")) if item in ("YoY", "YoY %", "MoM %") else (None,) * 3
        if item == "YoY":
            v = None if cur is None and py is None else (cur or 0) - (py or 0)
        elif item == "YoY %":
            v = None if not py else ((cur or 0) - py) / py
        elif item == "MoM %":
            v = None if not pm else ((cur or 0) - pm) / pm
        elif item == "3M Avg":
            v = at("3M Total")
            v = None if v is None else v / 3
        else:
            v = at(item)
        if v is not None:
            out[label] = v
    return out


def sample(seed, n):
    """(date, order, customer, revenue, returned): month ends, leap days, gaps, repeated ids."""
    rng = random.Random(seed)
    pool = [dt.date(2023, 1, 31), dt.date(2023, 2, 28), dt.date(2024, 2, 28), dt.date(2024, 2, 29), dt.date(2024, 3, 31),
            dt.date(2023, 3, 31), dt.date(2023, 4, 1), dt.date(2023, 11, 29), dt.date(2023, 11, 30), dt.date(2024, 5, 30)]
    pool += [dt.date(2023, 5, 1) + dt.timedelta(rng.randrange(500)) for _ in range(8)]
    return [
        (rng.choice(pool), f"o{rng.randrange(n // 2)}", f"c{rng.randrange(5)}", rng.randrange(1, 50), rng.random() < 0.3)
        for _ in range(n)
    ]


@pytest.fixture(scope="module")
def data(spark):
    rows = {"X": sample(3, 30), "Y": sample(4, 12)}
    lines = [
        {"order_date": d, "order_id": o, "customer_id": c, "unit_price": p, "is_returned": ret, "category": k, "sku": k}
        for k, rs in rows.items()
        for d, o, c, p, ret in rs
    ]
    star = make_star(make_lines(spark, lines))
    return rows, star, star.sales("category").persist()


CAL = [dt.date(2023, 1, 1) + dt.timedelta(i) for i in range(731)]


@pytest.mark.parametrize("grain", ["day", "month", "quarter", "year", "fiscal_year"])
@pytest.mark.parametrize("measure", ["total_revenue", "avg_order_value", "return_rate_pct"])
def test_items_match_their_definition(data, grain, measure):
    rows, _, frame = data
    got = time_calc(frame, (CAL[0], CAL[-1]), measure, ITEMS, ["category"], grain).collect()
    for category, sales in rows.items():
        for item in ITEMS:
            found = {r.period: float(r[item]) for r in got if r.category == category and r[item] is not None}
            assert found == pytest.approx(expected(measure, sales, CAL, grain, item)), (category, item)


def test_without_grouping_and_zero_sums_are_not_blank(spark):
    lines = [{"order_date": "2024-01-05", "unit_price": 0}, {"order_date": "2024-03-05", "unit_price": 7}]
    star = make_star(make_lines(spark, lines))
    bounds = star.calendar_bounds()
    got = {r.period: r for r in time_calc(star.fact_sales, tuple(bounds), "total_revenue", ["Current", "YTD"]).collect()}
    assert float(got["2024-01"].YTD) == 0 and got["2024-02"].Current is None and float(got["2024-02"].YTD) == 0
    assert float(got["2024-12"].YTD) == 7


def test_december_ytd_is_the_year(data):
    _, _, frame = data
    bounds = (CAL[0], CAL[-1])
    ytd = {r.period[:4]: r.YTD for r in time_calc(frame, bounds, "total_revenue", ["YTD"]).collect() if r.period.endswith("12")}
    year = {r.period: r.Current for r in time_calc(frame, bounds, "total_revenue", ["Current"], grain="year").collect()}
    assert ytd == year


def test_calc_group_long_form(data):
    _, _, frame = data
    long = calc_group(frame, (CAL[0], CAL[-1]), "total_revenue", ["category"]).collect()
    assert {r.calc: r.ordinal for r in long} == {c: i for i, c in enumerate(CALC_GROUP)}
    wide = time_calc(frame, (CAL[0], CAL[-1]), "total_revenue", ["YTD"], ["category"]).collect()
    assert {(r.period, r.category, r.value) for r in long if r.calc == "YTD"} == {
        (r.period, r.category, float(r.YTD)) for r in wide
    }


def test_unknown_names(data):
    _, _, frame = data
    with pytest.raises(ValueError):
        time_calc(frame, (CAL[0], CAL[-1]), "total_revenue", ["Nope"])
    with pytest.raises(ValueError):
        time_calc(frame, (CAL[0], CAL[-1]), "total_revenue", ["MTD"], grain="week")
