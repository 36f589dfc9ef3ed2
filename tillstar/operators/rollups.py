"""Hierarchies with subtotals."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstar.functions.columns import blank_if_zero
from tillstar.operators.measures import ADDITIVE, DISTINCT, bases_of, combine
from tillstar.star import Star

GEOGRAPHY = ("country", "state", "city", "store_name")
CALENDAR = ("year", "quarter", "month", "date")
PRODUCT = ("category", "subcategory", "product_name")


def hierarchy(
    star: Star,
    levels: Sequence[str],
    names: Sequence[str],
    period: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Measures at every level of a drill path, with the grand total.

    ``level`` is 0 for the total and counts the levels in scope. The fact is reduced
    once, by the surrogate key of the levels' dimension. Distinct counts are made to add
    up like sums: an identifier counts for a member of a level at its first leaf there
    (``first_places``). So identifiers are neither expanded per level nor shuffled again for
    it; what the rollup expands is a row per member of the dimension.
    """
    levels = list(levels)
    owners = [n for n, dim in star.dims().items() if set(levels) <= set(dim.columns)]
    if not owners:
        raise ValueError("the levels of a hierarchy come from one dimension")
    dim, key = getattr(star, owners[0]), star.KEYS[owners[0]]
    members = dim.select(key, *levels)
    fact = star.fact_sales if period is None else period(star.fact_sales)
    additive, distinct = bases_of(names)
    leaf = fact.groupBy(key).agg(*[F.sum(ADDITIVE[b]()).alias(f"_{b}") for b in additive], F.lit(1).alias("_seen"))
    for b in distinct:
        pairs = fact.select(key, DISTINCT[b]().alias("_id")).filter(F.col("_id").isNotNull()).distinct()
        leaf = leaf.join(first_places(pairs.join(members, key), key, levels, b), key, "left")
    # grouping_id has one bit per level out of scope; they are the trailing ones.
    level = (F.lit(len(levels)) - F.bit_count(F.grouping_id()).cast("int")).alias("level")
    summed = [F.sum(c).alias(c) for c in leaf.columns if c != key]
    rows = leaf.join(members, key).rollup(*levels).agg(*summed, level)
    for b in distinct:
        at_level = F.array(*[F.col(f"_{b}_{n}") for n in range(len(levels) + 1)])[F.col("level")]
        rows = rows.withColumn(f"_{b}", blank_if_zero(at_level))
    return combine(rows, list(names), ["level", *levels])


def first_places(pairs: DataFrame, key: str, levels: Sequence[str], base: str) -> DataFrame:
    """``key`` and for each level n how many identifiers have their first leaf of their level-n member there.

    ``pairs`` are distinct (key, _id) with the levels' texts. Sorted by these, an identifier enters a member
    of level n where one of the first n texts differs from the row before: one sort per identifier gives all
    levels. An identifier has a row per leaf at most, however many sales it holds.
    """
    inside = Window.partitionBy("_id").orderBy(*levels, key)
    entered = [F.row_number().over(inside) == 1]
    for c in levels:
        entered.append(entered[-1] | ~F.col(c).eqNullSafe(F.lag(c).over(inside)))
    marked = pairs.select(key, *[e.cast("long").alias(f"_{base}_{n}") for n, e in enumerate(entered)])
    return marked.groupBy(key).agg(*[F.sum(c).alias(c) for c in marked.columns if c != key])
