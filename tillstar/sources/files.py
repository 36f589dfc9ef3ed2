"""File scans and sinks of the gold layer."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tillstar.functions.columns import risk_order
from tillstar.session import hadoop_path, materialize
from tillstar.sources.schemas import FACT_ON_DISK, GOLD, RAW_ORDER_LINES


def read_order_lines(
    spark: SparkSession, path: str, schema: StructType = RAW_ORDER_LINES, fmt: str = "csv"
) -> DataFrame:
    """The raw extract: headered CSV with an explicit schema (or parquet).

    A row with another number of fields than the header fails the read, also where a query needs
    few columns. Quoted fields may hold line breaks only with ``multiLine``, which gives up
    splitting files; extracts are expected without them.
    """
    if fmt == "parquet":
        return spark.read.parquet(path)
    return _csv(spark, path, schema, mode="FAILFAST")


def read_order_lines_quarantined(spark: SparkSession, path: str, schema: StructType = RAW_ORDER_LINES) -> tuple[DataFrame, DataFrame]:
    """(good rows, malformed rows as ``record`` text) of the raw CSV extract, parsed once."""
    with_text = StructType([*schema.fields, StructField("record", StringType())])
    rows = materialize(_csv(spark, path, with_text, mode="PERMISSIVE", columnNameOfCorruptRecord="record"), "parsed")
    return rows.filter("record IS NULL").drop("record"), rows.filter("record IS NOT NULL").select("record")


def _csv(spark: SparkSession, path: str, schema: StructType, **options) -> DataFrame:
    # Doubled quotes are the CSV escape; enforceSchema=False compares the header names. Without
    # column pruning the parser sees whole rows.
    reader = spark.read.schema(schema).option("columnPruning", False)
    return reader.csv(path, header=True, escape='"', enforceSchema="record" in schema.names, **options)


def read_header(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """An exported CSV table as text, with the columns its own header names."""
    return spark.read.csv(f"{folder}/{name}", header=True, escape='"')


def write_order_lines(lines: DataFrame, path: str) -> None:
    writer = lines.write.mode("overwrite").option("escape", '"')
    writer.csv(path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def write_gold(
    tables: dict[str, DataFrame],
    folder: str,
    fmt: str = "parquet",
    observe: Callable[[DataFrame], DataFrame] = lambda fact: fact,
    finish: Callable[..., DataFrame] = lambda fact, *more: fact,
    compression: str | None = None,
) -> DataFrame | None:
    """Export every table; returns (table, path), None without tables.

    The parquet fact is partitioned by year and month, so files of different months never
    overlap in their days, and sorted by day within a file for row-group skipping. The
    rebalance hint lets AQE split a month that holds much of the data and merge small
    ones in a task. ``observe`` may attach metrics to the parquet fact; they are counted in
    the writing tasks, behind the last exchange, so a lost executor counts nothing twice. ``finish`` may make the
    fact's rows there out of narrower ones; it gets the columns to keep beside the fact's own. ``compression`` is that
    of CSV files, none unless given; readers tell it by the files' names.
    """
    if fmt not in ("parquet", "csv"):
        raise ValueError("fmt must be 'parquet' or 'csv'")
    if not tables:
        return None
    spark = None
    for name, df in tables.items():
        spark = df.sparkSession
        contract = [f.name for f in GOLD[name].fields]
        path = f"{folder}/{name}"
        if fmt == "csv":
            writer = df.select(*contract).write.mode("overwrite").option("escape", '"')
            writer.csv(path, header=True, compression=compression)
        elif name == "fact_sales":
            month = F.floor(F.col("date_key") / 100).cast("int")
            placed = df.withColumn("year_month_key", month).hint("rebalance", F.col("year_month_key"))
            year = F.floor(F.col("year_month_key") / 100).cast("int").alias("year")
            laid_out = observe(finish(placed, "year_month_key").select(*contract, year, "year_month_key"))
            laid_out = laid_out.sortWithinPartitions("year", "year_month_key", "date_key")
            laid_out.write.mode("overwrite").partitionBy("year", "year_month_key").parquet(path, compression="zstd")
        else:
            df.select(*contract).write.mode("overwrite").parquet(path)
    rows = [(name, f"{folder}/{name}") for name in tables]
    return spark.createDataFrame(rows, "`table` string, path string")


def new_version(folder: str) -> str:
    """A folder beside the published ones that nobody reads yet."""
    return f"{folder.rstrip('/')}/versions/{uuid.uuid4().hex[:12]}"


def _manifests(spark: SparkSession, folder: str) -> list[tuple[int, str]]:
    """Number and version of every manifest, the published one last: of one number the smallest version name counts."""
    fs, path = hadoop_path(spark, f"{folder.rstrip('/')}/manifests")
    if not fs.exists(path):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(path)]
    found = [re.fullmatch(r"(\d{9})-([0-9a-f]+)", n) for n in names]
    return sorted(sorted(((int(m[1]), m[2]) for m in found if m), key=lambda x: x[1], reverse=True), key=lambda x: x[0])


def publish(spark: SparkSession, folder: str, version: str, keep: int = 2) -> None:
    """Make a finished version the one that readers of ``folder`` get.

    One empty file named after the version is created last; no data is moved, so a failure
    before it leaves the old version published whole. Publishers at one time may take the same number:
    each looks again after creating its file, and one that finds a smaller name under its number, which
    readers take, goes on to the next number. So the last to look is published, on any storage that lists
    what was created, and nobody's version stays hidden behind an earlier one.
    Readers that opened an older version keep its files until ``keep`` newer ones exist.
    """
    root, name = folder.rstrip("/"), version.rpartition("/")[2]
    fs, manifests = hadoop_path(spark, f"{root}/manifests")
    fs.mkdirs(manifests)
    while True:
        done = _manifests(spark, folder)
        number = done[-1][0] + 1 if done else 1
        _, mark = hadoop_path(spark, f"{root}/manifests/{number:09d}-{name}")
        fs.create(mark, False).close()
        done = _manifests(spark, folder)
        if not [1 for n, rival in done if n == number and rival < name]:
            break
        fs.delete(mark, False)
    older = done[: done.index((number, name))]
    for old, gone in older[: max(0, len(older) + 1 - keep)]:
        for path in (f"{root}/manifests/{old:09d}-{gone}", f"{root}/versions/{gone}"):
            fs.delete(hadoop_path(spark, path)[1], True)


def published(spark: SparkSession, folder: str) -> str:
    """The published version's folder; ``folder`` itself where tables lie in it directly."""
    done = _manifests(spark, folder)
    return f"{folder.rstrip('/')}/versions/{done[-1][1]}" if done else folder


def read_gold(spark: SparkSession, folder: str, name: str, fmt: str = "csv") -> DataFrame:
    """A gold table with its declared column types, of the published version."""
    folder = published(spark, folder)
    if fmt == "parquet":
        schema = FACT_ON_DISK if name == "fact_sales" else GOLD[name]
        return spark.read.schema(schema).parquet(f"{folder}/{name}")
    return spark.read.schema(GOLD[name]).csv(
        f"{folder}/{name}", header=True, escape='"', enforceSchema=False, mode="FAILFAST"
    )


def read_scores(spark: SparkSession, folder: str, fmt: str = "csv") -> DataFrame:
    scores = read_gold(spark, folder, "customer_scores", fmt)
    return scores.withColumn("risk_order", risk_order("churn_risk"))


def read_cohorts(spark: SparkSession, folder: str, fmt: str = "csv") -> DataFrame:
    cohorts = read_gold(spark, folder, "cohort_retention", fmt)
    return cohorts.withColumn("retention", F.col("retention_pct") / 100).drop("retention_pct")


def security_map(spark: SparkSession, rows: Iterable[tuple[str, str]]) -> DataFrame:
    """User to country; a user may have several countries."""
    return spark.createDataFrame(list(rows), GOLD["security_user_country"])


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
