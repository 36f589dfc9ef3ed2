"""Staging: raw order lines to typed, trimmed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.sources.schemas import ORDER_LINES, ORDER_LINES_TEXT


def stage(raw: DataFrame, mode: str = "fail") -> DataFrame:
    """Trim the text columns and cast the others to the order-line types.

    ``mode='fail'`` stops the job at a bad value. ``mode='quarantine'`` keeps
    such rows, with NULL for the bad value and the column names in
    ``bad_columns``.
    """
    if mode not in ("fail", "quarantine"):
        raise ValueError("mode must be 'fail' or 'quarantine'")
    columns: list[Column] = []
    bad: list[Column] = []
    for field in ORDER_LINES.fields:
        c = F.col(field.name)
        if field.name in ORDER_LINES_TEXT:
            columns.append(F.trim(c).alias(field.name))
        elif mode == "fail":
            columns.append(c.cast(field.dataType).alias(field.name))
        else:
            typed = c.try_cast(field.dataType)
            columns.append(typed.alias(field.name))
            bad.append(F.when(c.isNotNull() & typed.isNull(), F.lit(field.name)))
    if mode == "quarantine":
        columns.append(F.array_compact(F.array(*bad)).alias("bad_columns"))
    return raw.select(*columns)


def quarantined(staged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split a quarantine-mode staging into (good rows, bad rows)."""
    is_bad = F.size("bad_columns") > 0
    return staged.filter(~is_bad).drop("bad_columns"), staged.filter(is_bad)
