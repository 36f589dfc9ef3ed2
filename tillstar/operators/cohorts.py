"""First-purchase cohorts and their retention."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.functions.columns import pct_one_decimal, quarter_label

MAX_MONTHS = 12
# Months of one word of an activity mask; below the sign bit.
WORD_MONTHS = 60


def first_purchase(orders: DataFrame, customer: str = "customer_id") -> DataFrame:
    """First purchase month and cohort quarter per customer."""
    first = orders.groupBy(customer).agg(F.trunc(F.min("order_date"), "month").alias("cohort_month"))
    return first.withColumn("cohort", quarter_label("cohort_month"))


def _last_full_cohort(horizon_end: str | dt.date, max_months: int) -> str:
    end = horizon_end if isinstance(horizon_end, dt.date) else dt.date.fromisoformat(horizon_end)
    month = end.year * 12 + end.month - 1 - max_months
    return f"{month // 12:04d}Q{month % 12 // 3 + 1}"


def activity_masks(
    orders: DataFrame, since: dt.date | None = None, until: dt.date | None = None, customer: str = "customer_id"
) -> DataFrame:
    """``customer, cohort_month, ages``: the first month with an order, and bit a of ``ages`` set where the
    customer ordered a months after it (up to 59 months are told apart).

    One aggregate over the orders: a bit per month of the calendar, OR-ed per customer into words of 60
    months. ``since`` and ``until`` bound the order dates; where they are not given they are read first.
    """
    if since is None or until is None:
        ends = orders.agg(F.min("order_date").alias("a"), F.max("order_date").alias("b")).first()
        since, until = since or ends["a"] or dt.date(1970, 1, 1), until or ends["b"] or dt.date(1970, 1, 1)
    start, last = since.year * 12 + since.month - 1, until.year * 12 + until.month - 1
    words = (last - start) // WORD_MONTHS + 1
    at = F.year("order_date") * 12 + F.month("order_date") - 1 - start
    bit = F.expr(f"shiftleft(1L, _at % {WORD_MONTHS})")
    spread = orders.select(customer, at.alias("_at")).filter(F.col("_at").between(0, last - start))
    word = F.floor(F.col("_at") / WORD_MONTHS)
    masks = spread.groupBy(customer).agg(*[F.bit_or(F.when(word == k, bit).otherwise(F.lit(0).cast("long"))).alias(f"w{k}") for k in range(words)])
    first = F.lit(None).cast("int")
    ages = F.lit(None).cast("long")
    full = F.lit((1 << WORD_MONTHS) - 1)
    for k in range(words - 1, -1, -1):
        w, following = F.col(f"w{k}"), F.col(f"w{k + 1}") if k + 1 < words else F.lit(0).cast("long")
        low = F.bit_count(w.bitwiseAND(-w) - 1)  # place of the lowest bit
        # The word from the first month on, filled up from the next word; two masks keep shifts within 60 bits.
        upper = F.call_function("shiftleft", following.bitwiseAND(F.call_function("shiftright", full, F.lit(WORD_MONTHS) - low)), F.lit(WORD_MONTHS) - low)
        aligned = F.call_function("shiftright", w, low).bitwiseOR(F.when(low > 0, upper).otherwise(F.lit(0).cast("long")))
        first, ages = F.when(w != 0, low + k * WORD_MONTHS).otherwise(first), F.when(w != 0, aligned).otherwise(ages)
    month = F.add_months(F.lit(dt.date(since.year, since.month, 1)), first)
    return masks.select(customer, month.alias("cohort_month"), ages.alias("ages"))


def cohort_retention(
    orders: DataFrame,
    horizon_end: str | dt.date,
    max_months: int = MAX_MONTHS,
    customer: str = "customer_id",
    since: dt.date | None = None,
    until: dt.date | None = None,
) -> DataFrame:
    """% of a quarter cohort active N months after each customer's own first month, long form.

    A customer's months are one bit mask, aligned to the first month: customers of a
    cohort with the same mask are counted together, and only these counts (a bounded
    number per cohort) are spread over the ages. Cohorts too young to have all
    ``max_months`` are left out; the denominator is the whole cohort.
    """
    if not 0 <= max_months < WORD_MONTHS:
        raise ValueError(f"at most {WORD_MONTHS - 1} months")
    seen = F.col("ages").bitwiseAND(F.lit((1 << (max_months + 1)) - 1)).alias("ages")
    masks = activity_masks(orders, since, until, customer).select(quarter_label("cohort_month").alias("cohort"), seen)
    masks = masks.filter(F.col("cohort") <= _last_full_cohort(horizon_end, max_months))
    counts = masks.groupBy("cohort", "ages").agg(F.count("*").alias("n"))
    bits = F.array(*[F.struct(F.lit(a).alias("age"), F.col("ages").bitwiseAND(F.lit(1 << a)).alias("on")) for a in range(max_months + 1)])
    spread = counts.select("cohort", "n", F.explode(bits).alias("at")).select("cohort", "n", "at.*")
    # Everyone of a cohort is active in month 0; its size comes with every age.
    aged = spread.groupBy("cohort", "age").agg(F.sum("n").alias("size"), F.sum(F.when(F.col("on") != 0, F.col("n"))).alias("active"))
    return aged.filter(F.col("active").isNotNull()).select(
        "cohort", F.col("age").alias("months_since_first"), pct_one_decimal("active", "size").alias("retention_pct")
    )


def month_retention(cohorts: DataFrame, k: int = 3) -> DataFrame:
    return cohorts.filter(F.col("months_since_first") == k).select("cohort", "retention_pct")


def cohort_pivot(cohorts: DataFrame, value: str = "retention_pct", max_months: int = MAX_MONTHS) -> DataFrame:
    """Matrix: one row per cohort, columns m0..m12 (fixed, so no extra job finds them)."""
    ages = list(range(max_months + 1))
    matrix = cohorts.groupBy("cohort").pivot("months_since_first", ages).agg(F.first(value))
    return matrix.select("cohort", *[F.col(str(a)).alias(f"m{a}") for a in ages])


def cohort_unpivot(matrix: DataFrame, value: str = "retention_pct") -> DataFrame:
    """Matrix back to long form; empty cells are dropped."""
    columns = [c for c in matrix.columns if c != "cohort"]
    long = matrix.unpivot("cohort", columns, "age", value).filter(F.col(value).isNotNull())
    return long.select("cohort", F.substring("age", 2, 10).cast("int").alias("months_since_first"), value)
