"""Raw order lines to the checked gold layer."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillstar.operators.checks import dq_gate, fact_metrics, observed_checks, staging_metrics
from tillstar.operators.dims import DOMESTIC, dim_customer, dim_date, dim_product, dim_store
from tillstar.operators.fact import fact_rows, placed_lines, stored_keys, stored_lines, with_customers
from tillstar.operators.staging import stage
from tillstar.session import bucket_count, hadoop_path, input_size, materialize, materialize_buckets, scratch_path, together, tune
from tillstar.sources.files import new_version, publish, read_gold, write_gold
from tillstar.star import Star


@dataclass(frozen=True)
class Built:
    """A finished run: staging, the star read back from its files, the checks."""

    stg: DataFrame
    star: Star
    checks: DataFrame
    folder: str


def run(
    raw: DataFrame,
    folder: str | None = None,
    domestic: str = DOMESTIC,
    fy_start_month: int = 4,
    security: DataFrame | None = None,
    fmt: str = "parquet",
) -> Built:
    """read -> stage -> dimensions -> fact -> checks -> gate -> export.

    What the checks ask of whole rows is counted while staging and the fact are written.
    Everything is written to a new version of ``folder``, which is published after the gate by
    one small file; a failed run leaves the old version as it was. A parquet star is not written
    twice; a CSV export is a second write by nature. Intermediate tables are deleted.
    """
    spark: SparkSession = tune(raw.sparkSession)
    staged = Observation()
    buckets = bucket_count(spark, input_size(raw))
    stg, in_buckets = materialize_buckets(_observed(stage(raw), staged, staging_metrics()), "staging", "sku", buckets)
    version = new_version(folder) if folder else None
    work = version if folder and fmt == "parquet" else scratch_path(spark, "star")
    try:
        built = _build(spark, stg, in_buckets, buckets, staged, work, domestic, fy_start_month)
        if folder:
            extra = {"security_user_country": security} if security is not None else {}
            write_gold(extra if fmt == "parquet" else built.star.tables() | extra, version, fmt)
            publish(spark, folder, version)
    except Exception:
        for left in {work, version} - {None}:
            fs, path = hadoop_path(spark, left)
            fs.delete(path, True)
        raise
    if folder is None or fmt != "parquet":
        return built
    return Built(stg, replace(_read_star(spark, folder), keyed=built.star.keyed), built.checks, folder)


def _read_star(spark: SparkSession, folder: str) -> Star:
    return Star(**{n: read_gold(spark, folder, n, "parquet") for n in (*Star.KEYS, "fact_sales")})


def _observed(df: DataFrame, into: Observation, metrics: dict[str, Column]) -> DataFrame:
    """``df`` whose writer also counts ``metrics``."""
    return df.observe(into, *[c.alias(n) for n, c in metrics.items()])


def _build(spark: SparkSession, stg: DataFrame, in_buckets: bool, buckets: int, staged: Observation, work: str, domestic: str, fy_start_month: int) -> Built:
    builders = {
        "dim_date": lambda: dim_date(stg, fy_start_month),
        "dim_store": lambda: dim_store(stg, domestic),
        "dim_product": lambda: dim_product(stg),
    }
    together(spark, *[lambda n=n, b=b: write_gold({n: b()}, work) for n, b in builders.items()])
    dims = {n: read_gold(spark, work, n, "parquet") for n in builders}
    # Lines are shuffled once to their customers: dimension, fact and customer analytics all start from there.
    placed = stored_lines(placed_lines(stg, dims["dim_store"], _joined(dims["dim_product"], in_buckets))).hint("rebalance", F.col("customer_id"))
    placed, in_buckets = materialize_buckets(placed, "placed", "customer_id", buckets, ("customer_id", "order_id"))
    write_gold({"dim_customer": dim_customer(placed)}, work)
    customers, written = read_gold(spark, work, "dim_customer", "parquet"), Observation()
    keyed = stored_keys(with_customers(placed, _joined(customers, in_buckets)))
    write_gold({"fact_sales": keyed}, work, observe=lambda f: _observed(f, written, fact_metrics()), finish=fact_rows)
    star = replace(_read_star(spark, work), keyed=placed if in_buckets else None)
    checks = materialize(observed_checks(star, written.get, staged.get), "checks")
    dq_gate(checks)
    return Built(stg, star, checks, work)


def _joined(dim: DataFrame, in_buckets: bool) -> DataFrame:
    """A dimension to join to lines: those in buckets of its key are neither shuffled nor sorted for it."""
    return dim.hint("shuffle_hash") if in_buckets else dim
