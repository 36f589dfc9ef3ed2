"""Global order without a one-partition window: dense keys and running sums.

Both place the rows by range on the sort columns (about equal shares per
partition, as the sort columns are unique), write that placement once, and add
per-partition offsets. The offsets table has one row per partition, at most
``spark.sql.shuffle.partitions``, so broadcasting it is bounded.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.session import materialize

# monotonically_increasing_id: partition number in the upper bits, row number in the lower 33.
_ROW_BITS = 33


def _placed(df: DataFrame, order: Sequence[Column | str], label: str) -> DataFrame:
    # No number given: AQE merges neighbouring ranges of a small input, which keeps their order.
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return materialize(ordered.withColumn("_slot", F.monotonically_increasing_id()), label)


def _part() -> Column:
    return F.shiftright(F.col("_slot"), _ROW_BITS)


def with_dense_key(df: DataFrame, order: Sequence[Column | str], name: str) -> DataFrame:
    """Add ``name`` = 1..n in the order of the (unique) ``order`` columns."""
    placed = _placed(df, order, name)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(_part().alias("_part"))
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    row = F.col("_slot").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    keyed = placed.withColumn("_part", _part()).join(F.broadcast(offsets), "_part")
    return keyed.select(*df.columns, (F.col("_before") + row + 1).alias(name))


def with_running_sums(df: DataFrame, order: Sequence[Column | str], sums: dict[str, str], label: str) -> DataFrame:
    """Add inclusive running sums ``{new column: summed column}`` in a global unique order."""
    placed = _placed(df, order, label).withColumn("_part", _part())
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("_part").agg(*[F.sum(c).alias(f"_{n}") for n, c in sums.items()])
    offsets = totals.select(
        "_part", *[F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(f"_{n}_before") for n in sums]
    )
    inside = Window.partitionBy("_part").orderBy("_slot").rowsBetween(Window.unboundedPreceding, 0)
    local = placed.select("*", *[F.sum(c).over(inside).alias(f"_{n}_local") for n, c in sums.items()])
    return local.join(F.broadcast(offsets), "_part").select(
        *df.columns, *[(F.col(f"_{n}_before") + F.col(f"_{n}_local")).alias(n) for n in sums]
    )


def with_dense_rank(df: DataFrame, value: str, name: str, within: Sequence[str] = ()) -> DataFrame:
    """Dense rank of ``value``, largest first; ``within`` these columns, if any.

    The distinct values get one global order. A rank within a group is the distance
    to the group's first key, so no group is gathered in one task.
    """
    ranked = with_dense_key(df.select(*within, value).distinct(), [*within, F.desc(value)], name)
    if within:
        ranked = materialize(ranked, name)
        first = ranked.groupBy(*within).agg(F.min(name).alias("_first"))
        ranked = ranked.join(first, list(within)).select(*within, value, (F.col(name) - F.col("_first") + 1).alias(name))
    return df.join(ranked, [*within, value])


def side_by_side(*rows: DataFrame) -> DataFrame:
    """One-row frames with different columns as one row, without a cross join."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    return stacked.agg(*[F.first(c, ignorenulls=True).alias(c) for c in stacked.columns])
