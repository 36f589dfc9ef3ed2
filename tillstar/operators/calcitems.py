"""Calculation items over measures that are evaluated in two stages.

A rank, a top-N value or a share of the parent is no sum over rows: under an item
its bases are moved to the item's period first and compared with the other members
there afterwards. The first stage is ``time_calc`` for the plain items (one pass
over the facts, a row per member and context); the second compares members per
context, a context being one period under one plain item; year-over-year items are
computed from the finished values last, as the calculation group does.

Scores and cohorts have no calendar: under any item they keep their value.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.functions.columns import blank_sub, ratio
from tillstar.operators.keys import with_dense_rank
from tillstar.operators.measures import MEASURES, retention_measure, score_measures
from tillstar.operators.ranking import top_n_value, with_share_of_parent
from tillstar.operators.timeintel import CALC_GROUP, DERIVED, calc_group, period_labels, time_calc
from tillstar.session import materialize
from tillstar.star import Star

Bounds = tuple[dt.date, dt.date]
# The items of the group that are periods of their own.
PLAIN = tuple(c for c in CALC_GROUP if c not in DERIVED)
SCORE_MEASURES = (
    "customers_scored", "high_risk_customers", "high_risk_pct", "avg_churn_probability", "observed_churn_pct", "revenue_at_risk",
)


def _contexts(wide: DataFrame, keys: Sequence[str]) -> DataFrame:
    """From a column per plain item to rows ``period, keys, calc, value``; blanks are left out."""
    items = F.array(*[F.struct(F.lit(c).alias("calc"), F.col(f"`{c}`").alias("value")) for c in PLAIN])
    rows = wide.select("period", *keys, F.explode(items).alias("item")).select("period", *keys, "item.*")
    return rows.filter(F.col("value").isNotNull())


def _group(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """All items of the calculation group from the values under the plain ones, in long form."""
    plain = {c: F.first(F.when(F.col("calc") == c, F.col(value).cast("double")), ignorenulls=True) for c in PLAIN}
    wide = rows.groupBy("period", *keys).agg(*[v.alias(f"={c}") for c, v in plain.items()])

    def item(calc: str) -> Column:
        now, before = F.col("=Current"), F.col("=PY")
        if calc == "YoY":
            return blank_sub(now, before)
        if calc == "YoY %":
            return F.when(before.isNotNull(), ratio(blank_sub(now, before), before))
        return F.col(f"={calc}")

    items = F.array(
        *[F.struct(F.lit(c).alias("calc"), F.lit(i).alias("ordinal"), item(c).alias("value")) for i, c in enumerate(CALC_GROUP)]
    )
    long = wide.select("period", *keys, F.explode(items).alias("item")).select("period", *keys, "item.*")
    return long.filter(F.col("value").isNotNull())


def ranked_in_contexts(
    star: Star,
    bounds: Bounds,
    column: str,
    measure: str = "total_revenue",
    grain: str = "month",
    members: Column | None = None,
    fy_start_month: int = 4,
) -> DataFrame:
    """``period, calc, column, value, rank``: dense rank of every member in every context.

    Members without a value take part as 0, in every period of the calendar. ``members``
    narrows the dimension and, through it, the sales. Ranks are found by one global
    order of the distinct values, so a context with very many members is no hot group.
    """
    owner = next((n for n, d in star.dims().items() if column in d.columns), None)
    if owner is None:
        raise ValueError(f"{column} is not a dimension column")
    dim = getattr(star, owner)
    if members is not None:
        dim = dim.filter(members)
        star = star.narrowed(owner, dim)
    wide = time_calc(star.sales(column), bounds, measure, PLAIN, [column], grain, fy_start_month)
    rows = materialize(_contexts(wide, [column]), "contexts")
    calendar = F.explode(period_labels(bounds, grain, fy_start_month)).alias("period")
    items = F.explode(F.array(*[F.lit(c) for c in PLAIN])).alias("calc")
    every = dim.select(column).distinct().select(column, calendar).select(column, "period", items)
    same = [every[c].eqNullSafe(rows[c]) for c in (column, "period", "calc")]
    known = every.join(rows, same[0] & same[1] & same[2], "left").select(
        every["period"], every["calc"], every[column], F.col("value"), F.coalesce("value", F.lit(0).cast(rows.schema["value"].dataType)).alias("_v")
    )
    return with_dense_rank(known, "_v", "rank", ["period", "calc"]).select("period", "calc", column, "value", "rank")


def calc_rank(star: Star, bounds: Bounds, column: str, **how) -> DataFrame:
    """The rank of every member under every item: period, column, calc, ordinal, value."""
    return _group(ranked_in_contexts(star, bounds, column, **how), [column], "rank")


def calc_top_n(star: Star, bounds: Bounds, n: int | None = None, column: str = "category", **how) -> DataFrame:
    """The value of the members ranked up to N in the same context, under every item."""
    limit = top_n_value(n)
    ranked = ranked_in_contexts(star, bounds, column, **how)
    return _group(ranked.filter(F.col("rank") <= limit), [column], "value")


def calc_share_of_parent(
    star: Star, bounds: Bounds, levels: Sequence[str], grain: str = "month", fy_start_month: int = 4
) -> DataFrame:
    """Revenue as a share of the enclosing level under every item: period, level, levels, calc, ordinal, value.

    Revenue adds up in every context, so the facts are reduced once, by surrogate
    key; the levels' texts join the reduced rows, which are summed up the hierarchy.
    """
    levels = list(levels)
    owner = next((n for n, d in star.dims().items() if set(levels) <= set(d.columns)), None)
    if owner is None:
        raise ValueError("the levels of a hierarchy come from one dimension")
    key = star.KEYS[owner]
    wide = time_calc(star.fact_sales, bounds, "total_revenue", PLAIN, [key], grain, fy_start_month)
    rows = _contexts(wide, [key]).join(getattr(star, owner).select(key, *levels), key)
    leaf = materialize(rows.groupBy("period", "calc", *levels).agg(F.sum("value").alias("value")), "leaf-contexts")
    sets = [["period", "calc", *levels[:n]] for n in range(len(levels) + 1)]
    # One bit of the grouping id per level out of scope; they are the trailing ones.
    depth = (F.lit(len(levels)) - F.bit_count(F.grouping_id()).cast("int")).alias("level")
    summed = leaf.groupingSets(sets, "period", "calc", *levels).agg(F.sum("value").alias("value"), depth)
    summed = materialize(summed, "level-contexts")
    shares = with_share_of_parent(summed, levels, "value", ["period", "calc"])
    return _group(shares, ["level", *levels], "share_of_parent")


def calc_constant(values: DataFrame, bounds: Bounds, by: Sequence[str], measure: str, grain: str = "month", fy_start_month: int = 4) -> DataFrame:
    """A measure without a calendar under every item: in every period each item is its value.

    ``values`` has a row per ``by``; it is repeated for the periods of the calendar only here.
    """
    items = F.explode(F.array(*[F.lit(c) for c in PLAIN])).alias("calc")
    periods = F.explode(period_labels(bounds, grain, fy_start_month)).alias("period")
    rows = values.select(*by, F.col(measure).alias("value"), periods).select("*", items)
    return _group(rows.filter(F.col("value").isNotNull()), by, "value")


def calc_any(
    measure: str,
    bounds: Bounds,
    by: Sequence[str] = (),
    star: Star | None = None,
    scores: DataFrame | None = None,
    cohorts: DataFrame | None = None,
    grain: str = "month",
    top: int | None = None,
    members: Column | None = None,
    fy_start_month: int = 4,
) -> DataFrame:
    """The calculation group over any measure of the model, found by its name.

    ``category_rank``, ``city_rank`` and ``top_n_revenue`` rank over their own column, whatever ``by``
    says; ``share_of_parent`` takes ``by`` as the levels of a hierarchy; score measures and
    ``retention_pct`` are evaluated over ``scores`` and ``cohorts``.
    """
    at = {"grain": grain, "fy_start_month": fy_start_month}
    if measure in MEASURES or measure == "new_customers":
        return calc_group(star.sales(*by), bounds, measure, by, **at)
    if measure in ("category_rank", "city_rank"):
        return calc_rank(star, bounds, measure.removesuffix("_rank"), members=members, **at)
    if measure == "top_n_revenue":
        return calc_top_n(star, bounds, top, "category", members=members, **at)
    if measure == "share_of_parent":
        return calc_share_of_parent(star, bounds, by, **at)
    if measure in SCORE_MEASURES:
        return calc_constant(score_measures(scores, by), bounds, by, measure, **at)
    if measure == "retention_pct":
        return calc_constant(retention_measure(cohorts, by), bounds, by, measure, **at)
    raise ValueError(f"no such measure: {measure}")
