"""Ranks, top-N, shares of the parent level and top-k lists."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.functions.columns import ratio
from tillstar.operators.keys import with_dense_rank
from tillstar.operators.measures import measure
from tillstar.star import Star

TOP_N_CHOICES = range(1, 11)
TOP_N_DEFAULT = 5


def _owner(star: Star, column: str) -> str:
    for name, dim in star.dims().items():
        if column in dim.columns:
            return name
    raise ValueError(f"{column} is not a dimension column")


def rank_by(
    star: Star,
    column: str,
    where: Column | None = None,
    touching: Sequence[str] = (),
    period: Callable[[DataFrame], DataFrame] | None = None,
    members: Column | None = None,
    name: str = "rank",
) -> DataFrame:
    """Dense rank by revenue over all members of a dimension column.

    Members without sales take part with revenue 0, as a blank ranks as 0.
    ``where`` / ``period`` are filters on the sales. ``members`` is the current selection:
    it narrows the dimension and, through its keys, the sales, so a name that also
    occurs outside the selection counts with its selected rows only.
    Returns column, revenue, rank.
    """
    owner = _owner(star, column)
    dim = getattr(star, owner)
    if members is not None:
        dim = dim.filter(members)
        star = star.narrowed(owner, dim)
    revenue = measure(star, "total_revenue", [column], where, touching, period)
    every = dim.select(column).distinct()
    known = every.join(revenue, every[column].eqNullSafe(revenue[column]), "left").select(
        every[column], F.col("total_revenue").alias("revenue")
    )
    ranked = with_dense_rank(known.withColumn("_v", F.coalesce("revenue", F.lit(0))), "_v", name)
    return ranked.select(column, "revenue", F.col(name).cast("long").alias(name))


def top_n_value(selected: int | None = None) -> int:
    """The what-if choice: 1..10, 5 when nothing (or not one value) is selected."""
    if selected is None:
        return TOP_N_DEFAULT
    if selected not in TOP_N_CHOICES:
        raise ValueError("top N must be 1..10")
    return selected


def top_n(
    star: Star,
    n: int | None = None,
    column: str = "category",
    period: Callable[[DataFrame], DataFrame] | None = None,
    total: bool = True,
) -> DataFrame:
    """Revenue of the members ranked up to N, NULL for the others; the total row keeps the total."""
    limit = top_n_value(n)
    ranked = rank_by(star, column, period=period)
    if total:  # members add up to the total: a row more per member, no second scan of the sales
        whole = ranked.rollup(column, "rank").agg(F.sum("revenue").alias("revenue"), F.grouping_id().alias("_id"))
        ranked = whole.filter(F.col("_id").isin(0, 3))
    shown = F.col("rank").isNull() | (F.col("rank") <= limit)
    return ranked.select(column, "rank", "revenue", F.when(shown, F.col("revenue")).alias("top_n_revenue"))


def with_share_of_parent(
    levels_frame: DataFrame, levels: Sequence[str], value: str = "total_revenue", within: Sequence[str] = ()
) -> DataFrame:
    """Share of the enclosing level for every row of a ``hierarchy`` result, apart for each value of ``within``.

    The parent's value is its own row, found by an equi-join on the parent's
    member columns: a parent with very many children is not gathered in one
    window group.
    """
    up = levels_frame.select(
        (F.col("level") + 1).alias("_level"), *[F.col(c).alias(f"_{c}") for c in (*levels, *within)], F.col(value).alias("_whole")
    )
    child = levels_frame
    depth = F.col("level")
    condition = depth == F.col("_level")
    for c in within:
        condition &= F.col(c) == F.col(f"_{c}")
    for i, c in enumerate(levels):
        # Above its own level a parent row has NULL; the child matches on the levels above its own.
        wanted = F.when(depth > i + 1, F.col(c))
        condition &= wanted.eqNullSafe(F.col(f"_{c}"))
    joined = child.join(up, condition, "left")
    whole = F.when(depth == 0, F.col(value)).otherwise(F.col("_whole"))
    return joined.select(*levels_frame.columns, ratio(F.col(value), whole).alias("share_of_parent"))


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First k rows; ``order`` ends in a unique tie-breaker. Each task keeps k rows only."""
    return df.orderBy(*order).limit(k)


def revenue_by(
    star: Star, column: str, period: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Members by revenue, largest first (members without kept sales are left out)."""
    rows = measure(star, "total_revenue", [column], period=period)
    return rows.filter(F.col("total_revenue").isNotNull()).orderBy(F.desc("total_revenue"), column)


def top_category(star: Star, period: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    rows = measure(star, "total_revenue", ["category"], period=period)
    return top_k(rows, [F.desc("total_revenue"), F.asc("category")], 1)
