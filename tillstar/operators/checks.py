"""Data-quality checks, the gate, and the schema and relationship contracts."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.operators.fact import line_amounts, net_revenue, orphan_keys
from tillstar.sources.schemas import GOLD, RELATIONSHIPS
from tillstar.star import Star

# Names of the five checks, in report order.
ROW_PARITY = "fact rows = staging rows"
ORPHAN_DATES = "orphan date keys"
DUPLICATE_CUSTOMERS = "duplicate customer keys"
NEGATIVE_REVENUE = "negative revenue"
RECONCILES = "revenue reconciles to staging (paise)"
CHECKS = (ROW_PARITY, ORPHAN_DATES, DUPLICATE_CUSTOMERS, NEGATIVE_REVENUE, RECONCILES)

# Fact columns without which no measure is right; a NULL among them would pass the sums unseen.
REQUIRED = (
    "order_id", "date_key", "customer_key", "store_key", "product_key", "quantity", "unit_price", "discount_pct",
    "net_revenue", "cost", "is_returned",
)


class QualityCheckError(RuntimeError):
    """A quality check found failing rows."""


def _tally(df: DataFrame, amounts: dict) -> DataFrame:
    """One scan of ``df`` to one (check_name, amount) row per entry."""
    named = {f"a{i}": c for i, c in enumerate(amounts.values())}
    one = df.agg(*[F.coalesce(c, F.lit(0)).cast("decimal(38,2)").alias(n) for n, c in named.items()])
    pairs = ", ".join(f"'{check}', a{i}" for i, check in enumerate(amounts))
    return one.selectExpr(f"stack({len(amounts)}, {pairs}) as (check_name, amount)")


def _settle(tallies: list[DataFrame]) -> DataFrame:
    both = reduce(DataFrame.unionByName, tallies)
    return both.groupBy("check_name").agg(F.abs(F.sum("amount")).cast("long").alias("failures"))


def _fact_rows():
    return {ROW_PARITY: F.count("*")}


def _stg_rows():
    return {ROW_PARITY: -F.count("*")}


def dq_row_parity(fact: DataFrame, stg: DataFrame) -> DataFrame:
    """Difference of the two row counts: fact counts plus, staging minus."""
    return _settle([_tally(fact, _fact_rows()), _tally(stg, _stg_rows())])


def dq_orphan_dates(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    return orphan_keys(fact, dim_date, "date_key").withColumn("check_name", F.lit(ORPHAN_DATES))


def dq_duplicate_keys(dim: DataFrame, key: str = "customer_key", name: str = DUPLICATE_CUSTOMERS) -> DataFrame:
    """Rows minus distinct keys; a NULL key counts as a failure.

    Duplicates are counted per key first: no distinct set is built in one task.
    """
    per_key = dim.groupBy(key).agg(F.count("*").alias("rows"))
    extra = F.sum(F.when(F.col(key).isNull(), F.col("rows")).otherwise(F.col("rows") - 1))
    return per_key.agg(F.coalesce(extra, F.lit(0)).cast("long").alias("failures")).select(
        F.lit(name).alias("check_name"), "failures"
    )


def _negative():
    return {NEGATIVE_REVENUE: F.count_if(F.col("net_revenue") < 0)}


def dq_negative_revenue(fact: DataFrame) -> DataFrame:
    return _settle([_tally(fact, _negative())])


def dq_revenue_reconciles(fact: DataFrame, stg: DataFrame) -> DataFrame:
    """Difference of the revenue sums, in hundredths of the currency."""
    paise = {RECONCILES: F.sum("net_revenue") * 100}
    expected = {RECONCILES: -F.sum("net_revenue") * 100}
    return _settle([_tally(fact, paise), _tally(line_amounts(stg), expected)])


def run_checks(star: Star, stg: DataFrame) -> DataFrame:
    """The five checks as (check_name, failures): one scan each of fact and staging
    for counts and sums, one keyed pass for orphans, one for duplicates."""
    paise = F.sum("net_revenue") * 100
    tallies = _settle(
        [
            _tally(star.fact_sales, {**_fact_rows(), **_negative(), RECONCILES: paise}),
            _tally(line_amounts(stg), {**_stg_rows(), RECONCILES: -paise}),
        ]
    )
    return tallies.unionByName(dq_orphan_dates(star.fact_sales, star.dim_date)).unionByName(
        dq_duplicate_keys(star.dim_customer)
    )


def extended_checks(star: Star) -> DataFrame:
    """What the five checks leave open: repeated keys of the other dimensions, whether the fact has
    rows at all, and whether its required columns are filled. One scan of the fact."""
    holes = {f"missing {c}": F.count_if(F.col(c).isNull()) for c in REQUIRED}
    parts = [_settle([_tally(star.fact_sales, {"empty fact": (F.count("*") == 0).cast("int"), **holes})])]
    for name, key in Star.KEYS.items():
        if name != "dim_customer":
            parts.append(dq_duplicate_keys(getattr(star, name), key, f"duplicate {key}"))
    return reduce(DataFrame.unionByName, parts)


def fact_metrics() -> dict[str, Column]:
    """What the checks need to know of the fact's rows, as aggregates that can be observed while it is written."""
    holes = {f"missing {c}": F.count_if(F.col(c).isNull()) for c in REQUIRED}
    return {"rows": F.count("*"), "negative": F.count_if(F.col("net_revenue") < 0), "paise": F.sum("net_revenue") * 100, **holes}


def staging_metrics() -> dict[str, Column]:
    return {"rows": F.count("*"), "paise": F.sum(net_revenue()) * 100}


def observed_checks(star: Star, fact: Mapping[str, object], stg: Mapping[str, object]) -> DataFrame:
    """The five checks and the extended ones from observed ``fact_metrics`` and ``staging_metrics``: neither the
    fact's columns nor staging are scanned again, only date keys and the dimensions' keys are."""
    of = lambda found, name: int(found.get(name) or 0)
    known = {
        ROW_PARITY: abs(of(fact, "rows") - of(stg, "rows")),
        NEGATIVE_REVENUE: of(fact, "negative"),
        RECONCILES: abs(of(fact, "paise") - of(stg, "paise")),
        "empty fact": int(of(fact, "rows") == 0),
        **{f"missing {c}": of(fact, f"missing {c}") for c in REQUIRED},
    }
    parts = [star.spark.createDataFrame(list(known.items()), "check_name string, failures bigint")]
    parts += [dq_orphan_dates(star.fact_sales, star.dim_date).select("check_name", "failures"), dq_duplicate_keys(star.dim_customer)]
    parts += [dq_duplicate_keys(getattr(star, n), k, f"duplicate {k}") for n, k in Star.KEYS.items() if n != "dim_customer"]
    return reduce(DataFrame.unionByName, parts)


def dq_gate(checks: DataFrame) -> DataFrame:
    """Raise on any failure (or missing result); return the checks otherwise.

    The failed rows are at most one per check.
    """
    failed = checks.filter(F.coalesce(F.col("failures") > 0, F.lit(True))).collect()
    if failed:
        lines = "\n".join(f"{r.check_name}: {r.failures}" for r in failed)
        raise QualityCheckError(f"quality checks failed\n{lines}")
    return checks


def schema_contract(tables: dict[str, DataFrame]) -> DataFrame:
    """One row (table, column, declared, found, bad_values, ok) per declared or found column.

    ``tables`` are the exports read as text, as their own headers name the columns.
    ``bad_values`` counts the texts that are not of the declared type, in one scan per table.
    """
    parts = []
    for name, df in tables.items():
        wanted = {f.name: f.dataType for f in GOLD[name].fields}
        both = [c for c in wanted if c in df.columns]
        bad = {c: F.count_if(F.col(f"`{c}`").isNotNull() & F.col(f"`{c}`").try_cast(wanted[c]).isNull()) for c in both}
        one = df.agg(F.count("*").alias("_rows"), *[e.alias(f"_{c}") for c, e in bad.items()])
        rows = [
            F.struct(
                F.lit(c).alias("column"), F.lit(c in wanted).alias("declared"), F.lit(c in df.columns).alias("found"),
                (F.col(f"`_{c}`") if c in bad else F.lit(0)).cast("long").alias("bad_values"),
            )
            for c in dict.fromkeys([*wanted, *df.columns])
        ]
        parts.append(one.select(F.lit(name).alias("table"), F.explode(F.array(*rows)).alias("x")).select("table", "x.*"))
    ok = F.col("declared") & F.col("found") & (F.col("bad_values") == 0)
    return reduce(DataFrame.unionByName, parts).withColumn("ok", ok)


def relationship_contract(tables: dict[str, DataFrame]) -> DataFrame:
    """Per relationship: rows on the many side without a partner, and repeated keys on the one side."""
    parts = []
    for (many, fk), (one, pk) in RELATIONSHIPS.items():
        if many not in tables:
            continue
        for table, column in ((many, fk), (one, pk)):
            if column not in tables[table].columns:
                raise ValueError(f"relationship column {table}.{column} does not exist")
        name = F.lit(f"{many}.{fk} -> {one}.{pk}").alias("relationship")
        lost = orphan_keys(tables[many].select(F.col(fk).alias(pk)), tables[one], pk)
        repeated = dq_duplicate_keys(tables[one], pk)
        parts.append(lost.select(name, F.lit("orphans").alias("kind"), "failures"))
        parts.append(repeated.select(name, F.lit("duplicates").alias("kind"), "failures"))
    return reduce(DataFrame.unionByName, parts)
