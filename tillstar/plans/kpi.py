"""The table of twelve expected measure values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.functions.columns import as_text, ratio
from tillstar.operators.context import Context, evaluate
from tillstar.operators.ranking import top_category
from tillstar.operators.fact import in_period
from tillstar.star import Star


def kpi_table(star: Star, year: int, country: str, fy: int | None = None, fy_start_month: int = 4) -> DataFrame:
    """(position, measure, context, value, text) for a reporting year.

    Eleven rows are measures in ten filter contexts, evaluated in one pass over the
    fact of the years they reach; the best category is a second, grouped pass.
    """
    fy = year if fy is None else fy
    fact = in_period(star.fact_sales, between=(f"{min(year, fy) - 1}-01-01", f"{max(year, fy)}-12-31"))
    scope = Star(**{**star.dims(), "fact_sales": fact})
    of = F.floor(F.col("date_key") / 10000)
    now = Context().select("date_key", of == year)
    before = now.where("date_key", of == year - 1)
    # The calendar's own filter is replaced where a row of the table looks at another period.
    fytd = now.where("date_key", F.lit(True)).where("fiscal_year", F.col("fiscal_year") == fy)
    half = now.where("date_key", F.col("date_key").between(year * 10000 + 101, year * 10000 + 630))
    names = ["total_revenue", "orders", "avg_order_value", "gross_margin_pct", "return_rate_pct", "active_customers"]
    cells = {n: (n, now) for n in names}
    cells["rev_py"], cells["fytd"], cells["ytd"] = ("total_revenue", before), ("total_revenue", fytd), ("total_revenue", half)
    cells["secured"] = ("total_revenue", now.keep("country", F.col("country") == country))
    one = evaluate(scope, cells)
    money, count = {"prefix": "₹ "}, {}
    one_digit, two_digits = {"decimals": 1, "suffix": "%", "times": 100}, {"decimals": 2, "suffix": "%", "times": 100}
    this, last = f"year = {year}", f"year = {year - 1}"
    # Position, label and context of the expected table.
    shown = [
        (1, "Total Revenue", this, F.col("total_revenue"), money),
        (2, "Total Revenue", last, F.col("rev_py"), money),
        (3, "Revenue YoY %", this, ratio("total_revenue", "rev_py") - 1, one_digit),
        (4, "Orders", this, F.col("orders"), count),
        (5, "Avg Order Value", this, F.col("avg_order_value"), money),
        (6, "Gross Margin %", this, F.col("gross_margin_pct"), one_digit),
        (7, "Return Rate %", this, F.col("return_rate_pct"), two_digits),
        (8, "Active Customers", this, F.col("active_customers"), count),
        (9, "Revenue FYTD", f"last date of FY{fy}", F.col("fytd"), money),
        (10, "Revenue YTD", f"30-Jun-{year}", F.col("ytd"), money),
        (12, f"Total Revenue (RLS: {country} Only)", this, F.col("secured"), money),
    ]

    def text(value, style):
        scaled = value.cast("decimal(38,6)") * style.get("times", 1)
        return as_text(scaled, style.get("decimals", 0), style.get("prefix", ""), style.get("suffix", ""))

    entries = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"), F.lit(label).alias("measure"), F.lit(context).alias("context"),
                value.cast("double").alias("value"), text(value, style).alias("text"),
            )
            for i, label, context, value, style in shown
        ]
    )
    table = one.select(F.explode(entries).alias("e")).select("e.*")
    best = top_category(star, lambda f: in_period(f, year=year)).select(
        F.lit(11).alias("position"),
        F.lit("Category Rank = 1").alias("measure"),
        F.lit(this).alias("context"),
        F.lit(None).cast("double").alias("value"),
        F.col("category").alias("text"),
    )
    return table.unionByName(best)
