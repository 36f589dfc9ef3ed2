"""Registered queries: one per operator (and variant), on the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar.operators import calcitems, checks, churn, cohorts, context, dims, distincts, fact, features, measures, metrics, ranking, rollups, security
from tillstar.operators.keys import with_dense_key
from tillstar.operators.staging import stage
from tillstar.operators.timeintel import calc_group, time_calc
from tillstar.plans import customers, report
from tillstar.plans.kpi import kpi_table
from tillstar.plans.warehouse import (
    COUNTRY,
    FORMULA_TERMS,
    CORPORATE,
    FY,
    HORIZON_END,
    SNAPSHOT,
    YEAR,
    Warehouse,
    formula_probability,
    open_warehouse,
)
from tillstar.session import materialize, scratch_path, tune
from tillstar.sources.bound import bind_order_lines
from tillstar.sources.files import read_cohorts, read_gold, read_header, read_order_lines, read_scores, write_gold
from tillstar.sources.schemas import GOLD

Query = Callable[[SparkSession, str], DataFrame]
CATALOG: dict[str, Query] = {}


def plain(df: DataFrame) -> DataFrame:
    """Decimals as double and dates as ISO text, so that two engines print the same."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        columns.append(c.alias(f.name))
    return df.select(*columns)


def query(name: str):
    """Register ``function(warehouse) -> DataFrame`` under ``name``."""

    def add(make: Callable[[Warehouse], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(make(open_warehouse(tune(spark), sf_dir)))

        CATALOG[name] = run
        return make

    return add


def _year(f: DataFrame) -> DataFrame:
    return fact.in_period(f, year=YEAR)


# ---------------------------------------------------------------- sources and sinks
@query("read_order_lines")
def _(w):
    return read_order_lines(w.spark, w.raw_csv)


@query("stage_order_lines")
def _(w):
    return stage(bind_order_lines(w.spark, w.sf_dir))


@query("stage_order_lines_csv")
def _(w):
    return stage(read_order_lines(w.spark, w.raw_csv))


@query("write_gold")
def _(w):
    folder = scratch_path(w.spark, "gold")
    write_gold(w.star.tables(), folder, "parquet")
    counts = [
        read_gold(w.spark, folder, name, "parquet").agg(F.lit(name).alias("table"), F.count("*").alias("rows"))
        for name in w.star.tables()
    ]
    return reduce(DataFrame.unionByName, counts)


def _read_gold(name: str, w: Warehouse) -> DataFrame:
    return read_gold(w.spark, w.gold_csv, name)


for _name in ("dim_date", "dim_customer", "dim_store", "dim_product", "fact_sales"):
    query(f"read_gold_{_name}")(partial(_read_gold, _name))


def _visible_stores(mapping: DataFrame, stores: DataFrame) -> DataFrame:
    """Stores each user of the mapping sees, per country."""
    per_country = stores.groupBy("country").agg(F.count("*").alias("stores"))
    return mapping.join(per_country, "country").select("user_email", "country", "stores")


@query("read_gold_security_user_country")
def _(w):
    return _visible_stores(_read_gold("security_user_country", w), _read_gold("dim_store", w))


@query("read_scores")
def _(w):
    return read_scores(w.spark, w.gold_csv)


@query("read_cohorts")
def _(w):
    return read_cohorts(w.spark, w.gold_csv)


@query("security_map")
def _(w):
    return _visible_stores(w.mapping, w.star.dim_store)


@query("order_line_scan")
def _(w):
    return fact.order_lines(w.star)


@query("analytics_summary")
def _(w):
    return customers.analytics_summary(w.base, w.split, w.model_metrics, w.drivers)


# ---------------------------------------------------------------- projections and filters
@query("line_amounts")
def _(w):
    lines = fact.line_amounts(w.stg)
    return lines.select("order_id", "sku", "quantity", "unit_price", "net_revenue", "discount_amount", "cost")


@query("kept_lines")
def _(w):
    return fact.kept(w.star.fact_sales).select("order_id", "product_key", "date_key", "net_revenue")


@query("period_filter_year")
def _(w):
    return _year(w.star.fact_sales).select("order_id", "date_key", "net_revenue")


@query("period_filter_fiscal_year")
def _(w):
    return fact.in_period(w.star.fact_sales, fy=FY).select("order_id", "date_key", "net_revenue")


@query("period_filter_range")
def _(w):
    found = fact.in_period(w.star.fact_sales, between=(f"{YEAR}-01-01", f"{YEAR}-06-30"))
    return found.select("order_id", "date_key", "net_revenue")


@query("history_asof")
def _(w):
    return fact.asof(w.base.lines, SNAPSHOT).select("customer_id", "order_id", "order_date", "net_revenue")


@query("history_after")
def _(w):
    return fact.after(w.base.lines, SNAPSHOT, HORIZON_END).select("customer_id", "order_id", "order_date")


@query("history_trailing_90d")
def _(w):
    return fact.trailing(w.base.lines, SNAPSHOT, 90).select("customer_id", "order_id", "order_date")


@query("active_customers_asof")
def _(w):
    found = features.customer_features(w.base.lines, SNAPSHOT, CORPORATE)
    return features.active_customers(found).select("customer_id", "recency_days")


# ---------------------------------------------------------------- joins
@query("fact_sales")
def _(w):
    return fact.build_fact(w.stg, w.star.dim_customer, w.star.dim_store, w.star.dim_product)


@query("star_join")
def _(w):
    joined = fact.star_join(w.star)
    return joined.select(
        "order_id", "date_key", "customer_id", "sku", "store_name", "city", "region", "category", "month_name",
        "fiscal_year", "net_revenue",
    )


@query("orphan_keys")
def _(w):
    return _orphans(w.star)


def _orphans(star) -> DataFrame:
    return reduce(DataFrame.unionByName, [fact.orphan_keys(star.fact_sales, d, star.KEYS[n]) for n, d in star.dims().items()])


@query("churn_label")
def _(w):
    found = features.active_customers(features.customer_features(w.base.lines, SNAPSHOT, CORPORATE))
    return features.churn_label(w.base.lines, found, SNAPSHOT, HORIZON_END).select("customer_id", "churned")


@query("scores_customer")
def _(w):
    renamed = w.scores.withColumnRenamed("segment", "rfm_segment")
    joined = renamed.join(w.star.dim_customer, "customer_id")
    return joined.select("customer_id", "customer_key", "segment", "signup_date", "rfm_segment", "churn_risk")


# ---------------------------------------------------------------- dimensions
@query("dim_date")
def _(w):
    return dims.dim_date(w.stg)


@query("dim_customer")
def _(w):
    return dims.dim_customer(w.stg)


@query("dim_store")
def _(w):
    return dims.dim_store(w.stg, COUNTRY)


@query("dim_product")
def _(w):
    return dims.dim_product(w.stg)


@query("distinct_stores")
def _(w):
    return dims.distinct_stores(w.stg)


@query("dense_key")
def _(w):
    orders = w.stg.select("order_id", "order_date").distinct()
    return with_dense_key(orders, [F.desc("order_date"), "order_id"], "position")


# ---------------------------------------------------------------- base measures
BY = ("category", "year")


def _measure(name: str, w: Warehouse) -> DataFrame:
    return measures.measure(w.star, name, BY)


for _name in measures.MEASURES:
    query(f"m_{_name}")(partial(_measure, _name))


@query("m_new_customers")
def _(w):
    month = F.floor(F.col("date_key") / 100).cast("int")
    return measures.new_customers(w.star.sales("category"), month, ["category"])


def _score_measure(name: str, w: Warehouse) -> DataFrame:
    return measures.score_measures(w.scores, ["segment"]).select("segment", name)


for _name in (
    "customers_scored", "high_risk_customers", "high_risk_pct", "avg_churn_probability", "observed_churn_pct",
    "revenue_at_risk",
):
    query(f"m_{_name}")(partial(_score_measure, _name))


@query("m_revenue_at_risk_12m")
def _(w):
    return measures.score_measures(w.scores, ["segment"], "monetary_12m").select("segment", "revenue_at_risk")


@query("m_retention_pct")
def _(w):
    return measures.retention_measure(w.cohorts, ["months_since_first"])


@query("m_by_customer_segment")
def _(w):
    return measures.measure(w.star, ["total_revenue", "gross_margin_pct", "discount_pct"], ["segment"])


@query("m_all_total")
def _(w):
    return measures.measure(w.star, list(measures.MEASURES))


@query("m_all_by_country_channel")
def _(w):
    return measures.measure(w.star, list(measures.MEASURES), ["country", "channel"])


# ---------------------------------------------------------------- other aggregates
@query("conditional_agg_yoy")
def _(w):
    return measures.conditional_agg_yoy(w.star, YEAR)


@query("geo_rollup")
def _(w):
    return rollups.hierarchy(w.star, rollups.GEOGRAPHY, ["total_revenue", "orders"])


@query("calendar_rollup")
def _(w):
    return rollups.hierarchy(w.star, rollups.CALENDAR, ["total_revenue", "units_sold"])


@query("product_rollup")
def _(w):
    return rollups.hierarchy(w.star, rollups.PRODUCT, ["total_revenue", "gross_margin_pct", "active_customers"])


@query("cohort_pivot")
def _(w):
    return cohorts.cohort_pivot(w.base.cohorts)


@query("cohort_unpivot")
def _(w):
    return cohorts.cohort_unpivot(cohorts.cohort_pivot(w.base.cohorts))


@query("segment_summary")
def _(w):
    return features.segment_summary(customers.with_churn(w.base))


@query("kpi_table")
def _(w):
    return kpi_table(w.star, YEAR, COUNTRY, FY)


# ---------------------------------------------------------------- time intelligence
NAMES = {
    "Current": "current", "PY": "py", "PM": "pm", "YoY": "yoy", "YoY %": "yoy_pct", "MoM %": "mom_pct",
    "MTD": "mtd", "QTD": "qtd", "YTD": "ytd", "FYTD": "fytd", "Running Total": "running_total",
    "3M Avg": "rolling_3m_avg",
}


def _time(measure: str, items: tuple, by: str, grain: str, w: Warehouse) -> DataFrame:
    out = time_calc(w.star.sales(by), w.bounds, measure, items, [by], grain)
    return out.withColumnsRenamed({c: NAMES[c] for c in items})


# name -> (measure, items, by, grain)
TIME_QUERIES: dict[str, tuple] = {
    "ti_py": ("total_revenue", ("Current", "PY"), "category", "month"),
    "ti_yoy": ("total_revenue", ("Current", "PY", "YoY"), "category", "month"),
    "ti_yoy_pct": ("total_revenue", ("YoY %",), "category", "month"),
    "ti_pm": ("total_revenue", ("Current", "PM"), "store_name", "month"),
    "ti_mom_pct": ("total_revenue", ("MoM %",), "store_name", "month"),
    "ti_mtd": ("total_revenue", ("MTD",), "category", "day"),
    "ti_qtd": ("total_revenue", ("QTD",), "category", "day"),
    "ti_ytd": ("total_revenue", ("YTD",), "store_name", "month"),
    "ti_fytd": ("total_revenue", ("FYTD",), "store_name", "month"),
    "running_total": ("total_revenue", ("Running Total",), "city", "month"),
    "rolling_3m_avg": ("total_revenue", ("3M Avg",), "store_name", "month"),
    "ti_mtd_orders": ("orders", ("MTD",), "category", "day"),
    "ti_qtd_orders": ("orders", ("QTD",), "category", "month"),
    "ti_ytd_orders": ("orders", ("YTD",), "category", "month"),
    "ti_fytd_orders": ("orders", ("FYTD",), "category", "month"),
    "ti_mtd_customers": ("active_customers", ("MTD",), "store_name", "month"),
    "ti_qtd_customers": ("active_customers", ("QTD",), "store_name", "month"),
    "ti_ytd_customers": ("active_customers", ("YTD",), "store_name", "month"),
    "ti_fytd_customers": ("active_customers", ("FYTD",), "store_name", "month"),
    "ti_rolling_orders": ("orders", ("Running Total", "3M Avg"), "category", "month"),
    "ti_quarter_aov": ("avg_order_value", ("Current", "PY", "PM", "QTD", "YTD"), "country", "quarter"),
    "ti_fiscal_year_margin": ("gross_margin_pct", ("Current", "PY", "YoY", "MTD", "FYTD"), "channel", "fiscal_year"),
    "ti_year_return_rate": ("return_rate_pct", ("Current", "PY", "MTD", "QTD"), "category", "year"),
}
for _name, _spec in TIME_QUERIES.items():
    query(_name)(partial(_time, *_spec))


# name -> (measure, by, grain)
CALC_GROUP_QUERIES: dict[str, tuple] = {
    "calc_group": ("total_revenue", "category", "month"),
    "calc_group_orders": ("orders", "country", "quarter"),
    "calc_group_aov": ("avg_order_value", "channel", "month"),
    "calc_group_discount": ("discount_pct", "state", "fiscal_year"),
    "calc_group_new_customers": ("new_customers", "category", "month"),
}


def _calc_group(measure: str, by: str, grain: str, w: Warehouse) -> DataFrame:
    return calc_group(w.star.sales(by), w.bounds, measure, [by], grain)


for _name, _spec in CALC_GROUP_QUERIES.items():
    query(_name)(partial(_calc_group, *_spec))


# measures of two stages and without a calendar under the items: name -> (measure, by, grain, further arguments)
CALC_ANY_QUERIES: dict[str, tuple] = {
    "calc_group_category_rank": ("category_rank", ("category",), "quarter", {}),
    "calc_group_city_rank": ("city_rank", ("city",), "month", {}),
    "calc_group_top_n": ("top_n_revenue", ("category",), "year", {"top": 3}),
    "calc_group_share_of_parent": ("share_of_parent", ("country", "state", "city"), "quarter", {}),
    "calc_group_high_risk_pct": ("high_risk_pct", ("segment",), "year", {}),
    "calc_group_retention": ("retention_pct", ("months_since_first",), "fiscal_year", {}),
}


def _calc_any(name: str, w: Warehouse) -> DataFrame:
    measure, by, grain, more = CALC_ANY_QUERIES[name]
    if measure == "city_rank":
        more = {"members": F.col("country") == COUNTRY}
    return calcitems.calc_any(measure, w.bounds, by, w.star, w.scores, w.cohorts, grain, **more)


for _name in CALC_ANY_QUERIES:
    query(_name)(partial(_calc_any, _name))


# ---------------------------------------------------------------- mergeable distinct counts
@query("distinct_cube_year")
def _(w):
    cube = distincts.DistinctCube.build(w.star, ["category"])
    return cube.count(["category", F.floor(F.col("month") / 100).cast("int").alias("year")])


@query("distinct_cube_country")
def _(w):
    cube = distincts.DistinctCube.build(w.star, ["country", "channel"])
    return cube.count(["country"], F.col("month").between(YEAR * 100 + 1, YEAR * 100 + 6))


@query("distinct_cube_trailing")
def _(w):
    return distincts.DistinctCube.build(w.star, ["country", "channel"]).trailing(["country"], 12)


@query("m_active_customers_approx")
def _(w):
    sketches = distincts.customer_sketches(w.star, ["category"])
    return distincts.approx_active_customers(sketches, ["category", F.floor(F.col("date_key") / 10000).cast("int").alias("year")])


# ---------------------------------------------------------------- ranking
@query("category_rank")
def _(w):
    return ranking.rank_by(w.star, "category", period=_year)


@query("city_rank")
def _(w):
    return ranking.rank_by(w.star, "city", members=F.col("country") == COUNTRY, period=_year)


@query("product_rank")
def _(w):
    return ranking.rank_by(w.star, "sku", period=_year)


@query("top_n_revenue")
def _(w):
    return ranking.top_n(w.star, 3, period=_year)


@query("top_n_revenue_default")
def _(w):
    return ranking.top_n(w.star)


@query("share_of_parent")
def _(w):
    levels = rollups.GEOGRAPHY
    return ranking.with_share_of_parent(rollups.hierarchy(w.star, levels, ["total_revenue"], _year), levels)


@query("rfm_scores")
def _(w):
    return features.rfm_scores(w.base.labelled).select("customer_id", "R", "F", "M")


@query("rfm_segment")
def _(w):
    return features.rfm_scores(w.base.labelled).select("customer_id", "segment")


@query("quantile_threshold")
def _(w):
    curve = metrics.score_curve(w.scores, "churn_probability", "churned_h2_2025")
    return metrics.quantile(curve, 0.8).select(F.round("threshold", 8).alias("threshold"))


@query("quantile_threshold_approx")
def _(w):
    parts = metrics.quantile_sketches(w.scores, "churn_probability", ["segment"])
    return metrics.sketched_quantile(parts, 0.8)


# ---------------------------------------------------------------- filter contexts
@query("context_shares")
def _(w):
    chosen = context.Context().select("year", F.col("year") == YEAR).select("country", F.col("country").isin("ASIA", "EUROPE"))
    return context.shares(w.star, ["country", "category"], chosen)


@query("context_counts")
def _(w):
    chosen = context.Context().select("year", F.col("year") == YEAR)
    online = chosen.keep("channel", F.col("channel") == "Online")
    cells = {
        "orders": ("orders", chosen),
        "orders_online": ("orders", online),
        "orders_all_cities": ("orders", chosen.all("city")),
        "customers": ("active_customers", chosen),
        "customers_ever": ("active_customers", chosen.remove(w.star.dim_date)),
        "customers_here_and_before": ("active_customers", chosen.where("year", F.col("year") == YEAR - 1)),
        "aov_online": ("avg_order_value", online),
    }
    return context.evaluate(w.star, cells, ["country", "city"])


# ---------------------------------------------------------------- sorts and limits
@query("top_category")
def _(w):
    return ranking.top_category(w.star, _year)


@query("highest_risk_customers")
def _(w):
    return report.highest_risk_customers(w.scores, 20)


@query("revenue_by_category")
def _(w):
    return ranking.revenue_by(w.star, "category", _year)


@query("churn_by_segment")
def _(w):
    return report.churn_by_segment(w.scores)


@query("sort_by_column")
def _(w):
    months = w.star.sales("month_name", "month").groupBy("month_name", "month").agg(F.count("*").alias("lines"))
    return months.orderBy("month")


@query("top_drivers")
def _(w):
    return churn.top_drivers(_formula_terms(w), 3)


def _formula_terms(w: Warehouse) -> DataFrame:
    found = churn.linear_terms(w.split.filter("is_test"), *FORMULA_TERMS)
    return found.select("feature", F.round("importance", 8).alias("importance"))


# ---------------------------------------------------------------- quality
@query("quality_checks")
def _(w):
    return checks.run_checks(w.star, w.stg)


@query("order_dedup")
def _(w):
    return fact.order_dedup(w.base.lines)


@query("dq_row_parity")
def _(w):
    return checks.dq_row_parity(w.star.fact_sales, w.stg)


@query("dq_orphan_dates")
def _(w):
    return checks.dq_orphan_dates(w.star.fact_sales, w.star.dim_date)


@query("dq_duplicate_keys")
def _(w):
    return checks.dq_duplicate_keys(w.star.dim_customer)


@query("dq_negative_revenue")
def _(w):
    return checks.dq_negative_revenue(w.star.fact_sales)


@query("dq_revenue_reconciles")
def _(w):
    return checks.dq_revenue_reconciles(w.star.fact_sales, w.stg)


@query("dq_gate")
def _(w):
    return checks.dq_gate(materialize(checks.run_checks(w.star, w.stg), "checks"))


@query("schema_contract")
def _(w):
    return checks.schema_contract({name: read_header(w.spark, w.gold_csv, name) for name in GOLD})


@query("schema_contract_damaged")
def _(w):
    tables = {name: read_header(w.spark, w.gold_csv, name) for name in GOLD}
    unpriced = F.when(F.col("product_key").cast("int") % 20 == 0, "n/a").otherwise(F.col("list_price"))
    tables["dim_product"] = tables["dim_product"].withColumnRenamed("brand", "label").withColumn("list_price", unpriced)
    return checks.schema_contract(tables)


@query("relationship_contract")
def _(w):
    return checks.relationship_contract(w.star.tables() | {"customer_scores": w.scores})


# The same checks where they must find something.
@query("dq_row_parity_damaged")
def _(w):
    return checks.dq_row_parity(w.damaged.fact_sales, w.stg)


@query("dq_orphan_dates_damaged")
def _(w):
    return checks.dq_orphan_dates(w.damaged.fact_sales, w.damaged.dim_date)


@query("dq_duplicate_keys_damaged")
def _(w):
    return checks.dq_duplicate_keys(w.damaged.dim_customer)


@query("dq_negative_revenue_damaged")
def _(w):
    return checks.dq_negative_revenue(w.damaged.fact_sales)


@query("dq_revenue_reconciles_damaged")
def _(w):
    return checks.dq_revenue_reconciles(w.damaged.fact_sales, w.stg)


@query("quality_checks_damaged")
def _(w):
    return checks.run_checks(w.damaged, w.stg)


@query("orphan_keys_damaged")
def _(w):
    return _orphans(w.damaged)


@query("relationship_contract_damaged")
def _(w):
    return checks.relationship_contract(w.damaged.tables() | {"customer_scores": w.scores})


# ---------------------------------------------------------------- security
@query("rls_static")
def _(w):
    return security.secure_static(w.star, COUNTRY).sales("country").groupBy("country").agg(F.count("*").alias("lines"))


def _rls(user: str, w: Warehouse) -> DataFrame:
    seen = security.secure_user(w.star, w.mapping, user)
    return measures.measure(seen, ["total_revenue", "orders"], ["country"])


query("rls_dynamic")(partial(_rls, "head"))
query("rls_dynamic_one_country")(partial(_rls, "europe.manager"))
query("rls_dynamic_unmapped")(partial(_rls, "nobody"))


def _rls_views(mapping: DataFrame, w: Warehouse) -> DataFrame:
    """SQL over secured views, as the session's own user."""
    security.secured_views(w.star, mapping, "secured_")
    return w.spark.sql(
        """SELECT country, SUM(net_revenue) AS total_revenue, COUNT(DISTINCT order_id) AS orders
        FROM secured_fact_sales JOIN secured_dim_store USING (store_key) WHERE NOT is_returned GROUP BY country"""
    )


@query("rls_views")
def _(w):
    me = w.spark.range(1).select(F.current_user().alias("user_email"), F.lit("EUROPE").alias("country"))
    return _rls_views(w.mapping.unionByName(me), w)


@query("rls_views_unmapped")
def _(w):
    return _rls_views(w.mapping, w)


@query("quality_checks_observed")
def _(w):
    return w.built.checks


@query("rls_measure")
def _(w):
    seen = security.secure_static(w.star, COUNTRY)
    return measures.measure(seen, ["total_revenue", "gross_margin_pct", "active_customers"], period=_year)


@query("rls_scores")
def _(w):
    seen = security.secure_user(w.star, w.mapping, "asia.manager")
    return security.secure_customers(w.scores, seen).select("customer_id", "churn_risk")


# ---------------------------------------------------------------- customer analytics
@query("first_purchase")
def _(w):
    return cohorts.first_purchase(fact.order_dedup(w.base.lines))


@query("cohort_retention")
def _(w):
    return cohorts.cohort_retention(fact.order_dedup(w.base.lines), HORIZON_END)


@query("month3_retention")
def _(w):
    return cohorts.month_retention(w.base.cohorts, 3)


@query("customer_features")
def _(w):
    return features.customer_features(w.base.lines, SNAPSHOT, CORPORATE)


@query("train_test_split")
def _(w):
    return churn.train_test_split(w.base.labelled).select("customer_id", "churned", "is_test")


def _test_metrics(name: str, w: Warehouse) -> DataFrame:
    return w.model_metrics.filter(F.col("model") == name)


query("churn_logistic")(partial(_test_metrics, "logistic_regression"))
query("churn_gbt")(partial(_test_metrics, "gradient_boosting"))


def _curve(w: Warehouse) -> DataFrame:
    return metrics.score_curve(w.scores, "churn_probability", "churned_h2_2025")


@query("roc_auc")
def _(w):
    return metrics.roc_auc(_curve(w)).select(F.round("roc_auc", 8).alias("roc_auc"))


@query("roc_auc_by_segment")
def _(w):
    curve = metrics.score_curve(w.scores, "churn_probability", "churned_h2_2025", ["segment"])
    return metrics.roc_auc(curve, ["segment"]).select("segment", F.round("roc_auc", 8).alias("roc_auc"))


@query("average_precision")
def _(w):
    return metrics.average_precision(_curve(w)).select(F.round("average_precision", 8).alias("average_precision"))


@query("lift_at_k")
def _(w):
    found = metrics.lift(_curve(w), 0.8)
    return found.select("top_customers", *[F.round(c, 8).alias(c) for c in ("threshold", "top_rate", "lift")])


@query("risk_band")
def _(w):
    return w.scores.select("customer_id", "churn_probability", "churn_risk")


@query("customer_scores_formula")
def _(w):
    return churn.score_frame(w.base.labelled, w.base.segments, formula_probability())


@query("customer_scores")
def _(w):
    scored = churn.with_probability(w.boosted, w.base.labelled)
    return churn.score_frame(scored, w.base.segments, F.col("p"))


@query("attribution")
def _(w):
    return churn.linear_attribution(w.logistic, w.split.filter("is_test"))


@query("attribution_formula")
def _(w):
    return _formula_terms(w)


@query("attribution_permutation")
def _(w):
    return w.drivers


# ---------------------------------------------------------------- report datasets
@query("rpt_overview_kpis")
def _(w):
    return report.report("overview_kpis", w.star, fy=FY)


@query("rpt_overview_kpis_user")
def _(w):
    return report.report("overview_kpis", w.star, fy=FY, user="head", mapping=w.mapping)


@query("rpt_fy_choices")
def _(w):
    return report.report("fy_choices", w.star, fy=FY)


@query("rpt_monthly_trend")
def _(w):
    return report.report("monthly_trend", w.star, fy=FY)


@query("rpt_geo_matrix")
def _(w):
    return report.report("geo_matrix", w.star, fy=FY)


@query("rpt_channel_mix")
def _(w):
    return report.report("channel_mix", w.star, fy=FY)


@query("rpt_category")
def _(w):
    return report.report("category", w.star, fy=FY)


@query("rpt_churn_kpis")
def _(w):
    return report.report("churn_kpis", scores=w.scores)


@query("rpt_risk_bands")
def _(w):
    return report.report("risk_bands", scores=w.scores)


@query("rpt_segment_churn")
def _(w):
    return report.report("segment_churn", scores=w.scores)


@query("rpt_highest_risk")
def _(w):
    return report.report("highest_risk", scores=w.scores)


@query("rpt_cohort_matrix")
def _(w):
    return report.report("cohort_matrix", cohorts=w.cohorts)
