"""Time intelligence: calculation items over any measure.

Contexts are the periods of the dense calendar. Facts are first reduced to
*atoms*, one row per (by, month) - or (by, day) at day grain - so everything
after the first aggregation is bounded by groups x calendar length.

Shift items (current, prior year, prior month) move each atom to the period it
is seen from. Cumulative items (to-date, running, rolling) are a sweep: an atom
at s counts in every context t with s <= t < leave(s), so it adds its value at
s and subtracts it at leave(s), and a running sum over the changes gives the
value of every context exactly. For distinct counts the same identifier must
not count twice: its interval ends where its next occurrence starts. A
customer or order seen on many days is therefore counted once per context
without any range join.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.functions.columns import blank_if_zero, blank_sub, ratio
from tillstar.operators.measures import ADDITIVE, DISTINCT, MEASURES, Measure, bases_of, first_purchases
from tillstar.session import materialize

# New customers add up over the first-purchase rows, which count like lines.
NEW_CUSTOMERS = Measure(("lines",), lambda b: b["lines"])

SHIFTS = {"Current": 0, "PY": 12, "PM": 1}  # months back
TO_DATE = ("MTD", "QTD", "YTD", "FYTD")
CUMULATIVE = (*TO_DATE, "Running Total", "3M Total")
# derived item -> items it is computed from
DERIVED = {"YoY": ("Current", "PY"), "YoY %": ("Current", "PY"), "MoM %": ("Current", "PM"), "3M Avg": ("3M Total",)}
# The items of the calculation group in display order.
CALC_GROUP = ("Current", "PY", "YoY", "YoY %", "MTD", "QTD", "YTD", "FYTD")
_MONTHS = {"month": 1, "quarter": 3, "year": 12}
GRAINS = ("day", "month", "quarter", "year", "fiscal_year")


class _Axis:
    """Integer time axis: month numbers (year * 12 + month - 1), or days since 1970."""

    def __init__(self, grain: str, first: dt.date, last: dt.date, fy_start_month: int):
        if grain not in GRAINS:
            raise ValueError(f"grain must be one of {GRAINS}")
        self.grain, self.daily, self.fy = grain, grain == "day", fy_start_month - 1
        self.first, self.last = (self._at(first), self._at(last))

    def _at(self, d: dt.date) -> int:
        return (d - dt.date(1970, 1, 1)).days if self.daily else d.year * 12 + d.month - 1

    def atom(self) -> Column:
        """Position of a row, from its ``date_key`` (no calendar join needed)."""
        k = F.col("date_key")
        y, m, d = F.floor(k / 10000).cast("int"), F.floor(k / 100).cast("int") % 100, k % 100
        return F.unix_date(F.make_date(y, m, d)) if self.daily else (y * 12 + m - 1).cast("int")

    def _month(self, at: Column) -> Column:
        if not self.daily:
            return at
        d = F.date_from_unix_date(at)
        return (F.year(d) * 12 + F.month(d) - 1).cast("int")

    def _start(self, month: Column) -> Column:
        """Position of the first atom of a month."""
        if not self.daily:
            return month.cast("int")
        return F.unix_date(F.make_date(F.floor(month / 12).cast("int"), (month % 12 + 1).cast("int"), F.lit(1)))

    def _forward(self, at: Column, months: int) -> Column:
        """First position whose date, moved ``months`` back, is not before ``at``."""
        if not self.daily:
            return at + months
        d = F.date_from_unix_date(at)
        e = F.add_months(d, months)
        clamped = F.dayofmonth(e) < F.dayofmonth(d)
        return F.unix_date(e) + F.when(clamped, 1).otherwise(0)

    def shifted(self, at: Column, months: int) -> tuple[Column, Column]:
        """[from, to) of the positions that see ``at`` when looking ``months`` back.

        At month grain this is one month. At day grain it may be empty
        (29 February) or several days (the end of a longer month).
        """
        if months == 0:
            return at, at + 1
        return self._forward(at, months), self._forward(at + 1, months)

    def aligned(self, months: int) -> bool:
        """Whether a shift moves whole periods onto whole periods of the calendar (whole years)."""
        return self.grain in _MONTHS and months % _MONTHS[self.grain] == 0

    def periods(self, months: int) -> int:
        return months // _MONTHS[self.grain]

    def leave(self, at: Column, calc: str) -> Column:
        """First position at which ``at`` no longer counts."""
        m = self._month(at)
        if calc == "MTD":
            return self._start(m + 1)
        if calc == "QTD":
            return self._start((F.floor(m / 3) + 1) * 3)
        if calc == "YTD":
            return self._start((F.floor(m / 12) + 1) * 12)
        if calc == "FYTD":
            return self._start((F.floor((m - self.fy) / 12) + 1) * 12 + self.fy)
        if calc == "Running Total":
            return F.lit(self.last + 1)
        if self.daily:  # three months ending with the day; a month end spans whole months
            return F.unix_date(F.add_months(F.date_from_unix_date(at), 3))
        return at + 3

    def period(self, at: Column) -> Column:
        """Period number of a position."""
        if self.grain in ("day", "month"):
            return at.cast("int")
        if self.grain == "quarter":
            return F.floor(at / 3).cast("int")
        if self.grain == "year":
            return F.floor(at / 12).cast("int")
        return (F.floor((at - self.fy) / 12) + (1 if self.fy else 0)).cast("int")

    def label(self, p: Column) -> Column:
        if self.grain == "day":
            return F.date_from_unix_date(p).cast("string")
        if self.grain == "month":
            return F.format_string("%04d-%02d", F.floor(p / 12).cast("int"), (p % 12 + 1).cast("int"))
        if self.grain == "quarter":
            return F.concat(F.floor(p / 4).cast("string"), F.lit("Q"), (p % 4 + 1).cast("string"))
        return p.cast("string")

    def closes_period(self, at: Column) -> Column:
        """True at the last position of a period, where cumulative items are read."""
        return (self.period(at) != self.period(at + 1)) | (at == self.last)


def period_labels(bounds: tuple[dt.date, dt.date], grain: str, fy_start_month: int = 4) -> Column:
    """All periods of the calendar, as one array."""
    axis = _Axis(grain, *bounds, fy_start_month)
    return F.transform(F.sequence(axis.period(F.lit(axis.first)), axis.period(F.lit(axis.last))), axis.label)


def _steps(axis: _Axis, items: Sequence[str], frame: DataFrame, by: Sequence[str], capped: bool) -> DataFrame:
    """Changes (by, calc, at, sign) of the cumulative items, one pair per atom and item."""
    at = F.col("at")
    changes = []
    for c in items:
        end = F.least(axis.leave(at, c), F.col("next_at")) if capped else axis.leave(at, c)
        for sign, where in ((1, at), (-1, end)):
            changes.append(
                F.struct(F.lit(c).alias("calc"), where.cast("int").alias("step"), F.lit(sign).alias("sign"))
            )
    moved = frame.withColumn("change", F.explode(F.array(*changes)))
    kept = [c for c in frame.columns if c not in ("at", "next_at")]
    return moved.select(*kept, "change.*").filter(F.col("step") <= axis.last)


def _sweep(axis: _Axis, steps: DataFrame, by: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Running sums over the changes, spread over the periods up to the next change."""
    changes = steps.groupBy(*by, "calc", "step").agg(*[F.sum(F.col("sign") * F.col(v)).alias(v) for v in values])
    # At most one row per group, item and calendar position: the window groups are bounded.
    w = Window.partitionBy(*by, "calc").orderBy("step")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    level = changes.select(
        *by, "calc", "step",
        *[F.sum(v).over(run).alias(v) for v in values],
        (F.coalesce(F.lead("step").over(w), F.lit(axis.last + 1)) - 1).alias("until"),
    ).filter(reduce(Column.__or__, [F.col(v) != 0 for v in values]))
    spread = level.withColumn("step", F.explode(F.sequence("step", "until")))
    closing = spread.filter(axis.closes_period(F.col("step")))
    return closing.select(*by, "calc", axis.period(F.col("step")).alias("p"), *values)


def _shift(axis: _Axis, items: Sequence[str], frame: DataFrame) -> DataFrame:
    """Each atom once per item and period it is seen from: adds (calc, p)."""
    at = F.col("at")

    def tagged(calc: str, positions: Column) -> Column:
        return F.transform(positions, lambda t: F.struct(F.lit(calc).alias("calc"), t.cast("int").alias("step")))

    seen = []
    for c in items:
        lo, hi = axis.shifted(at, SHIFTS[c])
        positions = F.when(hi > lo, F.sequence(lo, hi - 1)) if axis.daily else F.array(lo)
        seen.append(tagged(c, positions))
    empty = F.array().cast("array<struct<calc:string,step:int>>")
    every = F.flatten(F.array(*[F.coalesce(s, empty) for s in seen]))
    moved = frame.withColumn("seen", F.explode(every)).filter(F.col("seen.step").between(axis.first, axis.last))
    rest = [c for c in frame.columns if c != "at"]
    return moved.select(*rest, F.col("seen.calc").alias("calc"), axis.period(F.col("seen.step")).alias("p"))


def _cells(axis: _Axis, frame: DataFrame, by: Sequence[str], additive: Sequence[str], distinct: Sequence[str]) -> DataFrame:
    """The one pass over the facts: a row per (by, position), and per identifier where
    distinct counts are asked for. Written, as every item starts from it."""
    ids = [DISTINCT[b]().alias(f"id_{b}") for b in distinct]
    rows = frame.select(*by, axis.atom().alias("at"), *ids, "is_returned", *[ADDITIVE[b]().alias(f"_{b}") for b in additive])
    # _kept / _all: rows behind each base, so that a sum of 0 differs from no rows.
    sums = [
        *[F.coalesce(F.sum(f"_{b}"), F.lit(0)).alias(f"_{b}") for b in additive],
        F.count_if(~F.col("is_returned")).alias("_kept"),
        F.count("*").alias("_all"),
    ]
    return materialize(rows.groupBy(*by, "at", *[f"id_{b}" for b in distinct]).agg(*sums), "cells")


def time_calc(
    frame: DataFrame,
    bounds: tuple[dt.date, dt.date],
    measure: str,
    calcs: Sequence[str],
    by: Sequence[str] = (),
    grain: str = "month",
    fy_start_month: int = 4,
) -> DataFrame:
    """``measure`` under each calculation item, per period and ``by``.

    ``measure`` is a registered measure or ``new_customers``.

    ``frame`` is a fact frame with ``date_key`` and the ``by`` columns; filters
    on other columns are applied to it beforehand, period filters (slicers) to
    the result, as shifts look outside the slicer. ``bounds`` are the first and
    last day of the calendar. Returns ``period`` (text), ``by`` and one column
    per item; periods in which every item is blank are left out.
    """
    axis = _Axis(grain, *bounds, fy_start_month)
    by = list(by)
    known = {*SHIFTS, *CUMULATIVE, *DERIVED}
    if not calcs or set(calcs) - known:
        raise ValueError(f"items must be some of {sorted(known)}")
    if measure == "new_customers":
        frame = first_purchases(frame, by).withColumn("is_returned", F.lit(False))
        spec, additive, distinct = NEW_CUSTOMERS, list(NEW_CUSTOMERS.bases), []
    else:
        spec = MEASURES[measure]
        additive, distinct = bases_of([measure])
    needed = {x for c in calcs for x in DERIVED.get(c, (c,))}
    shifts = [c for c in SHIFTS if c in needed]
    sweeps = [c for c in CUMULATIVE if c in needed]
    pieces: list[DataFrame] = []
    values = [*[f"_{b}" for b in additive], "_kept", "_all"] if additive else []
    cells = _cells(axis, frame, by, additive, distinct)

    if additive:
        atoms = cells if not distinct else cells.groupBy(*by, "at").agg(*[F.sum(v).alias(v) for v in values])
        if shifts:
            moved = _shift(axis, shifts, atoms)
            pieces.append(moved.groupBy(*by, "calc", "p").agg(*[F.sum(v).alias(v) for v in values]))
        if sweeps:
            pieces.append(_sweep(axis, _steps(axis, sweeps, atoms, by, False), by, values))

    for b in distinct:
        ids = cells.select(*by, "at", F.col(f"id_{b}").alias("id")).filter(F.col("id").isNotNull())
        ids = ids.repartition(*by, "id").distinct()  # placed once, for the distinct and for the window below
        aligned = [c for c in shifts if axis.aligned(SHIFTS[c])]
        if aligned:
            per = ids.select(*by, axis.period(F.col("at")).alias("p"), "id").distinct().groupBy(*by, "p").agg(F.count("*").alias(f"_{b}"))
            moves = [F.struct(F.lit(c).alias("calc"), F.lit(axis.periods(SHIFTS[c])).alias("on")) for c in aligned]
            ends = axis.period(F.lit(axis.first)), axis.period(F.lit(axis.last))
            moved = per.withColumn("m", F.explode(F.array(*moves))).select(*by, "m.calc", (F.col("p") + F.col("m.on")).alias("p"), f"_{b}")
            pieces.append(moved.filter(F.col("p").between(*ends)))
        other = [c for c in shifts if c not in aligned]
        if other:
            moved = _shift(axis, other, ids)
            pieces.append(moved.groupBy(*by, "calc", "p").agg(F.count_distinct("id").alias(f"_{b}")))
        if sweeps:
            # When an identifier leaves depends on its day and its next day only: count these pairs first.
            again = Window.partitionBy(*by, "id").orderBy("at")
            spans = ids.withColumn("next_at", F.lead("at").over(again)).groupBy(*by, "at", "next_at").agg(F.count("*").alias(f"_{b}"))
            pieces.append(_sweep(axis, _steps(axis, sweeps, spans, by, True), by, [f"_{b}"]))

    long = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), pieces)

    def item(calc: str) -> Column:
        """The measure under one item, from its transformed bases."""
        bases = {}
        for b in additive:
            rows = F.col(f"{calc}_kept" if b in ("revenue", "cost", "units") else f"{calc}_all")
            bases[b] = F.when(rows > 0, F.col(f"{calc}_{b}"))
        for b in distinct:
            bases[b] = blank_if_zero(F.col(f"{calc}_{b}"))
        return spec.combine(bases)

    parts = [*additive, *distinct, *(["kept", "all"] if additive else [])]
    wide = long.groupBy(*by, "p").agg(
        *[F.sum(F.when(F.col("calc") == c, F.col(f"_{x}"))).alias(f"{c}_{x}") for c in (*shifts, *sweeps) for x in parts]
    )
    base = wide.select(*by, "p", *[item(c).alias(f"={c}") for c in (*shifts, *sweeps)])

    def value(calc: str) -> Column:
        cur, py, pm = F.col("=Current"), F.col("=PY"), F.col("=PM")
        if calc == "YoY":
            return blank_sub(cur, py)
        if calc == "YoY %":
            return F.when(py.isNotNull(), ratio(blank_sub(cur, py), py))
        if calc == "MoM %":
            return ratio(blank_sub(cur, pm), pm)
        if calc == "3M Avg":
            return ratio(F.col("=3M Total"), F.lit(3))
        return F.col(f"={calc}")

    out = base.select(axis.label(F.col("p")).alias("period"), *by, *[value(c).alias(c) for c in calcs])
    return out.filter(reduce(Column.__or__, [F.col(f"`{c}`").isNotNull() for c in calcs]))


def calc_group(
    frame: DataFrame,
    bounds: tuple[dt.date, dt.date],
    measure: str,
    by: Sequence[str] = (),
    grain: str = "month",
    fy_start_month: int = 4,
) -> DataFrame:
    """All items of the calculation group in long form: period, by, calc, ordinal, value."""
    wide = time_calc(frame, bounds, measure, CALC_GROUP, by, grain, fy_start_month)
    items = F.array(
        *[
            F.struct(
                F.lit(c).alias("calc"), F.lit(i).alias("ordinal"), F.col(f"`{c}`").cast("double").alias("value")
            )
            for i, c in enumerate(CALC_GROUP)
        ]
    )
    long = wide.select("period", *by, F.explode(items).alias("item")).select("period", *by, "item.*")
    return long.filter(F.col("value").isNotNull())
