"""The gold layer of one input folder, built once per Spark application.

As in the batch job it stands for, reports and measures read finished gold
tables; only the first query of a session pays for building them.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.functions.columns import ratio
from tillstar.operators import churn
from tillstar.plans import customers, etl
from tillstar.session import hadoop_path, materialize, scratch_path, together
from tillstar.sources.bound import TABLES, bind_order_lines
from tillstar.sources.schemas import ORDER_LINES_TEXT
from tillstar.sources.files import security_map, write_gold, write_order_lines
from tillstar.star import Star

# Parameters of the given tables.
YEAR = 2000
FY = 2000
COUNTRY = "ASIA"
CORPORATE = "BUILDING"
SNAPSHOT = "2000-12-31"
HORIZON_END = "2001-06-30"
USERS = (
    ("asia.manager", "ASIA"),
    ("europe.manager", "EUROPE"),
    ("head", "ASIA"),
    ("head", "EUROPE"),
)


def formula_probability():
    """A fixed-weight logistic score: stands in for a fitted model where the result
    must be computable elsewhere."""
    z = (
        F.lit(-1.5)
        + F.col("recency_days") * F.lit(0.02)
        + F.col("return_rate") * F.lit(0.5)
        - F.col("orders_last_90d") * F.lit(0.25)
        - F.col("online_share") * F.lit(0.75)
    )
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


# The formula's linear terms: features, weights, centres.
FORMULA_TERMS = (("recency_days", "return_rate", "orders_last_90d", "online_share"), (0.02, 0.5, -0.25, -0.75), (100.0, 0.25, 1.0, 0.5))


@dataclass(frozen=True)
class Warehouse:
    spark: SparkSession
    sf_dir: str

    @cached_property
    def built(self) -> etl.Built:
        return etl.run(bind_order_lines(self.spark, self.sf_dir), domestic=COUNTRY)

    @property
    def star(self) -> Star:
        return self.built.star

    @property
    def stg(self) -> DataFrame:
        return self.built.stg

    @cached_property
    def bounds(self):
        b = self.star.calendar_bounds()
        return b["first"], b["last"]

    @cached_property
    def mapping(self) -> DataFrame:
        return security_map(self.spark, USERS)

    @cached_property
    def raw_csv(self) -> str:
        """The order lines as the headered CSV extract the ETL starts from: texts padded, nothing staged."""
        path = scratch_path(self.spark, "order-lines-csv")
        lines = bind_order_lines(self.spark, self.sf_dir)
        padded = {c: F.concat(F.lit("  "), F.col(c), F.lit(" ")) for c in ORDER_LINES_TEXT}
        write_order_lines(lines.withColumns(padded), path)
        return path

    @cached_property
    def damaged(self) -> Star:
        """The star with known faults: what the quality checks must find."""
        s = self.star
        turned = F.when(F.col("product_key") % 50 == 0, -F.col("net_revenue")).otherwise(F.col("net_revenue"))
        return Star(
            dim_date=s.dim_date.filter(~((F.col("year") == YEAR) & (F.col("month") == 1))),
            dim_customer=s.dim_customer.filter("customer_key % 7 <> 0").unionAll(s.dim_customer.filter("customer_key <= 3")),
            dim_store=s.dim_store.filter("store_key <> 2"),
            dim_product=s.dim_product.filter("product_key % 11 <> 0"),
            fact_sales=s.fact_sales.filter("store_key <> 1").withColumn("net_revenue", turned.cast("decimal(18,2)")),
        )

    @cached_property
    def base(self) -> customers.Base:
        return customers.prepare(self.star, SNAPSHOT, HORIZON_END, CORPORATE)

    @cached_property
    def scores(self) -> DataFrame:
        return materialize(
            churn.score_frame(self.base.labelled, self.base.segments, formula_probability()), "formula-scores"
        )

    @cached_property
    def cohorts(self) -> DataFrame:
        """Cohort retention in read form (a fraction)."""
        return self.base.cohorts.select("cohort", "months_since_first", ratio("retention_pct", F.lit(100)).alias("retention"))

    @cached_property
    def split(self) -> DataFrame:
        return materialize(churn.train_test_split(self.base.labelled), "split")

    @cached_property
    def logistic(self):
        return churn.fit_logistic(self.split.filter(~F.col("is_test")))

    @cached_property
    def boosted(self):
        """The boosted model, fitted once per application."""
        return churn.fit_gbt(self.split.filter(~F.col("is_test")))

    @cached_property
    def model_metrics(self) -> DataFrame:
        """Test metrics of both models, which are fitted side by side."""
        together(self.spark, lambda: self.logistic, lambda: self.boosted)
        test = self.split.filter("is_test")
        return materialize(
            churn.evaluate(churn.with_probability(self.logistic, test), "logistic_regression").unionByName(
                churn.evaluate(churn.with_probability(self.boosted, test), "gradient_boosting")
            ),
            "metrics",
        )

    @cached_property
    def drivers(self) -> DataFrame:
        """Importance of the features for the boosted model."""
        return materialize(churn.permutation_attribution(self.boosted, self.split.filter("is_test")), "drivers")

    @cached_property
    def gold_csv(self) -> str:
        """Every gold table exported as headered CSV, which takes a fact row 100 bytes as it is and a quarter of it compressed."""
        path = scratch_path(self.spark, "gold-csv")
        tables = self.star.tables() | {
            "security_user_country": self.mapping,
            "customer_scores": self.scores,
            "cohort_retention": self.base.cohorts,
        }
        write_gold(tables, path, "csv", compression="gzip")
        return path


_OPEN: dict[tuple, Warehouse] = {}


def _version(spark: SparkSession, sf_dir: str) -> tuple:
    """Size and time of the input tables, so that changed files are built anew."""
    marks = []
    for name in TABLES:
        fs, path = hadoop_path(spark, f"{sf_dir}/{name}.parquet")
        marks.append((fs.getContentSummary(path).getLength(), fs.getFileStatus(path).getModificationTime()))
    return tuple(marks)


def open_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    key = (spark.sparkContext.applicationId, sf_dir, _version(spark, sf_dir))
    if key not in _OPEN:
        _OPEN[key] = Warehouse(spark, sf_dir)
    return _OPEN[key]
