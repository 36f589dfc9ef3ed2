"""Filter contexts as values, and many of them evaluated in one scan.

A context holds the tests in force per column and, apart from them, those of the
reader's selection. Operations give a new context: ``where`` replaces what a column is
filtered by, ``keep`` adds to it, ``all`` lifts it, ``all_selected`` goes back to the
selection, ``remove`` lifts a whole dimension. Grouping by a column is a filter on that
column as well: an operation that replaces or lifts it makes the cell leave that
grouping column out.

``evaluate`` marks every row with the contexts it belongs to, a bit each, and sums per
mark. Distinct counts reduce to one row per identifier with its marks OR-ed. However
many contexts are asked for, the facts are read once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.functions.columns import blank_if_zero
from tillstar.operators.measures import ADDITIVE, DISTINCT, MEASURES, bases_of
from tillstar.session import materialize
from tillstar.star import Star

#: Contexts of one scan; a mark is a long.
MOST = 62
Tests = Mapping[str, tuple[Column, ...]]


@dataclass(frozen=True, eq=False)
class Context:
    """``here`` filters the rows, ``selection`` is what the reader chose; ``off`` are columns whose grouping no longer holds."""

    here: Tests = field(default_factory=dict)
    selection: Tests = field(default_factory=dict)
    off: frozenset[str] = frozenset()

    def select(self, column: str, test: Column) -> Context:
        """A choice of the reader (a slicer): filters, and is what ``all_selected`` returns to."""
        return replace(self, here={**self.here, column: (test,)}, selection={**self.selection, column: (test,)})

    def where(self, column: str, test: Column) -> Context:
        """``test`` in place of any filter on the column."""
        return replace(self, here={**self.here, column: (test,)}, off=self.off | {column})

    def keep(self, column: str, test: Column) -> Context:
        """``test`` besides the filters on the column."""
        return replace(self, here={**self.here, column: (*self.here.get(column, ()), test)})

    def all(self, *columns: str) -> Context:
        """No filter on the columns."""
        return replace(self, here={c: t for c, t in self.here.items() if c not in columns}, off=self.off | set(columns))

    def all_selected(self, *columns: str) -> Context:
        """On the columns only what the reader chose."""
        lifted = self.all(*columns)
        return replace(lifted, here={**lifted.here, **{c: self.selection[c] for c in columns if c in self.selection}})

    def remove(self, dimension: DataFrame) -> Context:
        """No filter on any column of a dimension."""
        return self.all(*dimension.columns)

    def test(self) -> Column:
        return reduce(Column.__and__, [t for tests in self.here.values() for t in tests], F.lit(True))


Cell = tuple[str, Context]


def evaluate(star: Star, cells: Mapping[str, Cell], by: Sequence[str] = ()) -> DataFrame:
    """``by`` and a column per cell: its measure in its context, for every member (combination) of
    ``by`` with a row in some context. Without ``by``, one row."""
    by = list(by)
    contexts = list({id(c): c for _, c in cells.values()}.values())
    if not 0 < len(contexts) <= MOST:
        raise ValueError(f"1 to {MOST} contexts in one scan")
    bit = {id(c): 1 << i for i, c in enumerate(contexts)}
    touched = sorted({c for x in contexts for c in x.here})
    additive, distinct = bases_of([m for m, _ in cells.values()])
    marks = [F.when(c.test(), F.lit(bit[id(c)])).otherwise(0) for c in contexts]
    ids = [DISTINCT[b]().alias(f"id_{b}") for b in distinct]
    frame = star.sales(*by, *touched).select(
        *by, reduce(Column.__add__, marks).cast("long").alias("_mark"), *ids, *[ADDITIVE[b]().alias(f"_{b}") for b in additive]
    )
    keys = [*by, *[f"id_{b}" for b in distinct], "_mark"]
    sums = [F.sum(f"_{b}").alias(f"_{b}") for b in additive]
    # The one pass over the facts; every cell starts from it.
    marked = materialize(frame.filter("_mark <> 0").groupBy(*keys).agg(*sums, F.lit(1).alias("_one")), "marked")
    out = marked.select(*by).distinct() if by else None
    for kept in dict.fromkeys(tuple(c for c in by if c not in x.off) for _, x in cells.values()):
        here = {n: x for n, x in cells.items() if tuple(c for c in by if c not in x[1].off) == kept}
        part = _part(marked, list(kept), here, bit)
        if out is None:
            out = part
        elif kept == tuple(by):
            out = _joined(out, part, by)
        else:
            out = _joined(out, part, list(kept))
    return out.select(*by, *cells)


def _part(marked: DataFrame, keys: list[str], cells: Mapping[str, Cell], bit: Mapping[int, int]) -> DataFrame:
    """The cells of one grouping: sums per context, and identifiers counted from their marks."""
    wanted = list({id(c): c for _, c in cells.values()}.values())
    additive, distinct = bases_of([m for m, _ in cells.values()])

    def has(c: Context, column: str = "_mark") -> Column:
        return F.col(column).bitwiseAND(F.lit(bit[id(c)])) != 0

    name = {id(c): str(i) for i, c in enumerate(wanted)}
    sums = [F.sum(F.when(has(c), F.col(f"_{b}"))).alias(f"{name[id(c)]}_{b}") for c in wanted for b in additive]
    parts = [marked.groupBy(*keys).agg(*sums, F.lit(1).alias("_one"))]
    for b in distinct:
        found = marked.filter(F.col(f"id_{b}").isNotNull()).groupBy(*keys, f"id_{b}").agg(F.bit_or("_mark").alias("_m"))
        counts = [blank_if_zero(F.count_if(has(c, "_m"))).alias(f"{name[id(c)]}_{b}") for c in wanted]
        parts.append(found.groupBy(*keys).agg(*counts))
    rows = parts[0]
    if distinct:
        both = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)
        rows = both.groupBy(*keys).agg(*[F.max(c).alias(c) for c in both.columns if c not in keys])
    values = []
    for n, (m, c) in cells.items():
        bases = {b: F.col(f"{name[id(c)]}_{b}") for b in MEASURES[m].bases}
        values.append(MEASURES[m].combine(bases).alias(n))
    return rows.select(*keys, *values)


def _joined(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on keys that may be null; without keys the right side's one row goes to every row."""
    if not keys:
        one = right.first()
        return left.select("*", *[F.lit(one[f.name]).cast(f.dataType).alias(f.name) for f in right.schema.fields])
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in keys})
    on = reduce(Column.__and__, [left[c].eqNullSafe(renamed[f"_r_{c}"]) for c in keys])
    return left.join(renamed, on, "left").drop(*[f"_r_{c}" for c in keys])


def shares(star: Star, by: Sequence[str], context: Context | None = None, measure: str = "total_revenue") -> DataFrame:
    """``by``, the measure, its share of the members beside it (the last column of ``by`` lifted to the selection),
    of all selected, and of the same members without any filter on the calendar: four contexts, one scan."""
    base = Context() if context is None else context
    cells = {
        measure: (measure, base),
        "_beside": (measure, base.all_selected(by[-1])),
        "_selected": (measure, base.all_selected(*by)),
        "_ever": (measure, base.remove(star.dim_date)),
    }
    found = evaluate(star, cells, by)
    part = {"share_of_beside": "_beside", "share_of_selected": "_selected", "share_of_ever": "_ever"}
    value = F.col(measure).cast("double")
    return found.select(*by, measure, *[F.try_divide(value, F.col(c).cast("double")).alias(n) for n, c in part.items()])
