"""Column helpers shared by the operators. All of them stay JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Risk bands and their display order.
LOW_RISK_UP_TO = 0.3
MEDIUM_RISK_UP_TO = 0.6
RISK_ORDER = {"High": 1, "Medium": 2, "Low": 3}


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(num: Column | str, den: Column | str) -> Column:
    """Division in double; NULL for a NULL or zero denominator."""
    return F.try_divide(as_column(num).cast("double"), as_column(den).cast("double"))


def blank_sub(a: Column | str, b: Column | str) -> Column:
    """a - b where one missing side counts as 0 and two missing sides stay missing."""
    a, b = as_column(a), as_column(b)
    return F.when(a.isNotNull() | b.isNotNull(), F.coalesce(a, F.lit(0)) - F.coalesce(b, F.lit(0)))


def blank_if_zero(count: Column | str) -> Column:
    """A count over no rows is blank, not 0."""
    return F.nullif(as_column(count).cast("long"), F.lit(0).cast("long"))


def pct_one_decimal(part: Column | str, whole: Column | str) -> Column:
    """100 * part / whole, half-up to one decimal, in integer arithmetic."""
    p, w = as_column(part).cast("long"), as_column(whole).cast("long")
    doubled = p * 2000 + w
    tenths = (doubled - doubled % (w * 2)).cast("double") / (w * 2).cast("double")
    return tenths / F.lit(10.0)


def date_key(date: Column | str) -> Column:
    d = as_column(date)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def fiscal_year(date: Column | str, start_month: int = 4) -> Column:
    """Fiscal year named after the calendar year in which it ends."""
    d = as_column(date)
    if start_month == 1:
        return F.year(d)
    return F.year(d) + F.when(F.month(d) >= start_month, 1).otherwise(0)


def quarter_label(date: Column | str) -> Column:
    d = as_column(date)
    return F.concat(F.year(d).cast("string"), F.lit("Q"), F.quarter(d).cast("string"))


def months_between_starts(later: Column | str, earlier: Column | str) -> Column:
    a, b = as_column(later), as_column(earlier)
    return (F.year(a) - F.year(b)) * 12 + F.month(a) - F.month(b)


def quartile(rank: Column | str, rows: Column | str) -> Column:
    """Equal-frequency quarter (1..4) of a unique rank; cut points interpolate linearly."""
    r, n = as_column(rank).cast("long"), as_column(rows).cast("long")
    at = (r - 1) * 4
    return (
        1
        + (at > n - 1).cast("int")
        + (at > (n - 1) * 2).cast("int")
        + (at > (n - 1) * 3).cast("int")
    ).cast("int")


def rfm_segment(r: str = "R", f: str = "F", m: str = "M") -> Column:
    recent, frequent, big = F.col(r) >= 3, F.col(f) >= 3, F.col(m) >= 3
    return (
        F.when(recent & frequent & big, "Champions")
        .when(recent & ~frequent, "Promising")
        .when(~recent & frequent, "At risk")
        .when(~recent & ~frequent, "Hibernating")
        .otherwise("Needs attention")
    )


def risk_band(p: Column | str, closed: str = "right") -> Column:
    """Low / Medium / High. ``closed='right'`` puts an edge value in the lower band."""
    p = as_column(p)
    if closed == "right":
        low, medium = p <= LOW_RISK_UP_TO, p <= MEDIUM_RISK_UP_TO
    elif closed == "left":
        low, medium = p < LOW_RISK_UP_TO, p < MEDIUM_RISK_UP_TO
    else:
        raise ValueError("closed must be 'right' or 'left'")
    in_range = (p >= 0) & (p <= 1)
    return F.when(in_range & low, "Low").when(in_range & medium, "Medium").when(in_range, "High")


def risk_order(band: Column | str) -> Column:
    band = as_column(band)
    return (
        F.when(band == "High", RISK_ORDER["High"])
        .when(band == "Medium", RISK_ORDER["Medium"])
        .otherwise(RISK_ORDER["Low"])
    )


def as_text(value: Column | str, decimals: int = 0, prefix: str = "", suffix: str = "") -> Column:
    """Display text of a number: thousands grouped for whole numbers, fixed decimals otherwise."""
    v = F.round(as_column(value).cast("decimal(38,6)"), decimals)
    digits = v.cast(f"decimal(38,{decimals})").cast("string") if decimals else F.format_number(v, 0)
    return F.concat(F.lit(prefix), digits, F.lit(suffix))
