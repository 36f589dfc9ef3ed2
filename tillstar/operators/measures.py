"""Named measures: aggregates evaluated over any grouping of a filtered frame.

A measure is an expression over *bases*. Additive bases are conditional sums;
distinct bases are conditional distinct counts. Keeping the two kinds apart lets
every caller (plain aggregation, hierarchies, time intelligence) transform the
bases first and divide afterwards.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.functions.columns import blank_if_zero, blank_sub, ratio
from tillstar.star import Star


def _kept() -> Column:
    return ~F.col("is_returned")


# Row-level input of each additive base; the base is its sum (NULL where no row counts).
ADDITIVE: dict[str, Callable[[], Column]] = {
    "revenue": lambda: F.when(_kept(), F.col("net_revenue")),
    "cost": lambda: F.when(_kept(), F.col("cost")),
    "units": lambda: F.when(_kept(), F.col("quantity").cast("long")),
    "lines": lambda: F.lit(1).cast("long"),
    "returned": lambda: F.col("is_returned").cast("long"),
    "all_discount": lambda: F.col("discount_amount"),
    "all_net": lambda: F.col("net_revenue"),
}

# Row-level identifier of each distinct base; the base is its distinct count.
DISTINCT: dict[str, Callable[[], Column]] = {
    "orders": lambda: F.when(_kept(), F.col("order_id")),
    "customers": lambda: F.when(_kept(), F.col("customer_key")),
}

Bases = Mapping[str, Column]


@dataclass(frozen=True)
class Measure:
    """``combine`` turns the evaluated bases into the value, as double or long."""

    bases: tuple[str, ...]
    combine: Callable[[Bases], Column]


def _margin(b: Bases) -> Column:
    return blank_sub(b["revenue"], b["cost"])


MEASURES: dict[str, Measure] = {
    "total_revenue": Measure(("revenue",), lambda b: b["revenue"]),
    "total_cost": Measure(("cost",), lambda b: b["cost"]),
    "gross_margin": Measure(("revenue", "cost"), _margin),
    "gross_margin_pct": Measure(("revenue", "cost"), lambda b: ratio(_margin(b), b["revenue"])),
    "orders": Measure(("orders",), lambda b: b["orders"]),
    "units_sold": Measure(("units",), lambda b: b["units"]),
    "active_customers": Measure(("customers",), lambda b: b["customers"]),
    "avg_order_value": Measure(("revenue", "orders"), lambda b: ratio(b["revenue"], b["orders"])),
    "return_rate_pct": Measure(("returned", "lines"), lambda b: ratio(b["returned"], b["lines"])),
    "discount_pct": Measure(
        ("all_discount", "all_net"), lambda b: ratio(b["all_discount"], b["all_discount"] + b["all_net"])
    ),
    "revenue_per_customer": Measure(("revenue", "customers"), lambda b: ratio(b["revenue"], b["customers"])),
}


def register_measure(name: str, bases: Sequence[str], combine: Callable[[Bases], Column]) -> None:
    """Add a user-defined measure over the existing bases."""
    unknown = [b for b in bases if b not in ADDITIVE and b not in DISTINCT]
    if unknown:
        raise ValueError(f"unknown bases: {unknown}")
    MEASURES[name] = Measure(tuple(bases), combine)


def bases_of(names: Iterable[str]) -> tuple[list[str], list[str]]:
    """(additive, distinct) bases the measures need, in a fixed order."""
    needed = {b for n in names for b in MEASURES[n].bases}
    return [b for b in ADDITIVE if b in needed], [b for b in DISTINCT if b in needed]


def combine(df: DataFrame, names: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """From one column per base to one column per measure."""
    bases = {b: F.col(f"_{b}") for b in (*ADDITIVE, *DISTINCT)}
    return df.select(*by, *[MEASURES[n].combine(bases).alias(n) for n in names])


def aggregate(frame: DataFrame, names: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Measures per ``by`` over an already filtered frame.

    With two distinct bases Spark would expand every input row once per base;
    the rows are first reduced to one per (group, order, customer), so the
    expansion works on that smaller input.
    """
    additive, distinct = bases_of(names)
    sums = [F.sum(ADDITIVE[b]()).alias(f"_{b}") for b in additive]
    if not distinct:
        return combine(frame.groupBy(*by).agg(*sums), names, by)
    if len(distinct) == 1:
        counts = [F.count_distinct(DISTINCT[b]()) for b in distinct]
        based = frame.groupBy(*by).agg(*sums, *[blank_if_zero(c).alias(f"_{b}") for b, c in zip(distinct, counts)])
        return combine(based, names, by)
    ids = [DISTINCT[b]().alias(f"_{b}") for b in distinct]
    reduced = frame.select("*", *ids).groupBy(*by, *[f"_{b}" for b in distinct]).agg(*sums, F.lit(1).alias("_seen"))
    based = reduced.groupBy(*by).agg(
        *[F.sum(f"_{b}").alias(f"_{b}") for b in additive],
        *[blank_if_zero(F.count_distinct(f"_{b}")).alias(f"_{b}") for b in distinct],
    )
    return combine(based, names, by)


def measure(
    star: Star,
    names: Sequence[str] | str,
    by: Sequence[str] = (),
    where: Column | None = None,
    touching: Sequence[str] = (),
    period: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Measures of the star per ``by``.

    ``where`` may use fact columns, ``by`` columns and the dimension columns
    named in ``touching``; ``period`` narrows the fact before any join.
    Customer attributes join late when all measures add up: the fact is summed
    per customer first, so the large customer table meets one row per customer
    instead of one per order line.
    """
    names = [names] if isinstance(names, str) else list(names)
    if period is not None:
        star = Star(**{**star.dims(), "fact_sales": period(star.fact_sales)})
    additive, distinct = bases_of(names)
    late = [c for c in by if c in star.dim_customer.columns and c not in star.fact_sales.columns]
    if late and not distinct and not set(touching) & set(star.dim_customer.columns):
        early = [c for c in by if c not in late]
        frame = star.sales(*early, *touching)
        frame = frame if where is None else frame.filter(where)
        per_customer = frame.groupBy("customer_key", *early).agg(
            *[F.sum(ADDITIVE[b]()).alias(f"_{b}") for b in additive]
        )
        named = per_customer.join(star.dim_customer.select("customer_key", *late), "customer_key")
        sums = [F.sum(f"_{b}").alias(f"_{b}") for b in additive]
        return combine(named.groupBy(*by).agg(*sums), names, by)
    frame = star.sales(*by, *touching)
    frame = frame if where is None else frame.filter(where)
    return aggregate(frame, names, by)


def conditional_agg_yoy(star: Star, year: int) -> DataFrame:
    """Revenue of a year and the one before in one pass, and the growth."""
    scope = star.fact_sales.filter(F.col("date_key").between((year - 1) * 10000, (year + 1) * 10000))
    if "year" in scope.columns:
        scope = scope.filter(F.col("year").between(year - 1, year))
    of = F.floor(F.col("date_key") / 10000)
    sums = scope.agg(
        F.sum(F.when(_kept() & (of == year), F.col("net_revenue"))).alias("revenue"),
        F.sum(F.when(_kept() & (of == year - 1), F.col("net_revenue"))).alias("revenue_py"),
    )
    return sums.select("revenue", "revenue_py", (ratio("revenue", "revenue_py") - 1).alias("yoy_pct"))


def first_purchases(frame: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per (by, customer): the date key of the first-ever purchase, returns included.

    The first date is taken within ``by`` and the frame's filters but over all
    dates. New customers of any set of dates are the rows that fall into it.
    """
    return frame.groupBy(*by, "customer_key").agg(F.min("date_key").alias("date_key"))


def new_customers(frame: DataFrame, period: Column, by: Sequence[str] = ()) -> DataFrame:
    """Customers whose first-ever purchase falls in the period, an expression over ``date_key``."""
    first = first_purchases(frame, by)
    return first.groupBy(*by, period.alias("period")).agg(F.count("*").alias("new_customers"))


def score_measures(scores: DataFrame, by: Sequence[str] = (), monetary: str = "monetary") -> DataFrame:
    """The six churn measures over customer scores.

    Probabilities have four decimals, so they are averaged as exact decimals.
    """
    high = F.col("churn_risk") == "High"
    agg = scores.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.count_if(high).alias("high"),
        F.sum(F.col("churn_probability").cast("decimal(10,4)")).alias("p"),
        F.sum(F.col("churned_h2_2025").cast("long")).alias("churned"),
        F.sum(F.when(high, F.col(monetary).cast("decimal(28,2)"))).alias("at_risk"),
    )
    return agg.select(
        *by,
        blank_if_zero("n").alias("customers_scored"),
        blank_if_zero("high").alias("high_risk_customers"),
        ratio(blank_if_zero("high"), "n").alias("high_risk_pct"),
        ratio("p", "n").alias("avg_churn_probability"),
        ratio("churned", "n").alias("observed_churn_pct"),
        F.col("at_risk").alias("revenue_at_risk"),
    )


def retention_measure(cohorts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean retention of the cohorts and months in context (read form: a fraction).

    The percentages have one decimal, so they are averaged as exact decimals.
    """
    pct = F.round(F.col("retention") * 100, 1).cast("decimal(6,1)")
    agg = cohorts.groupBy(*by).agg(F.sum(pct).alias("p"), F.count("retention").alias("n"))
    return agg.select(*by, (ratio("p", "n") / 100).alias("retention_pct"))
