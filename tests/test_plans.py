"""Physical plans: pruning, pushdown, no cross joins, skewed joins split."""

import re
from dataclasses import replace

import pytest
from support import make_lines, make_star
from pyspark.sql import functions as F

from tillstar.operators import measures
from tillstar.operators.fact import build_fact, fact_rows, in_period, keyed_lines, order_lines, stored_keys
from tillstar.operators.features import customer_features
from tillstar.plans import etl
from tillstar.plans.catalog import CATALOG
from tillstar.plans.warehouse import open_warehouse
from tillstar.sources.bound import bind_order_lines
from tillstar.sources.files import read_gold, write_gold

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_year_filter_prunes_partitions_and_is_pushed(spark):
    star = open_warehouse(spark, SF_DIR).star
    text = plan(measures.measure(star, "total_revenue", ["category"], period=lambda f: in_period(f, year=2000)))
    scan = next(x for x in text.split("\n") if "FileScan" in x and "net_revenue" in x)
    assert re.search(r"PartitionFilters: \[.*year.*2000", scan)
    assert "GreaterThanOrEqual(date_key,20000101)" in scan and "LessThanOrEqual(date_key,20001231)" in scan
    columns = re.search(r"ReadSchema: struct<([^>]*)>", scan).group(1)
    assert {c.split(":")[0] for c in columns.split(",") if ":" in c} == {"product_key", "is_returned", "date_key", "net_revenue"}


def test_month_filter_reads_one_month(spark):
    """Files of different months have disjoint days, so a month costs a month."""
    star = open_warehouse(spark, SF_DIR).star
    year = in_period(star.fact_sales, year=1997)
    month = in_period(star.fact_sales, between=("1997-05-01", "1997-05-31"))
    files, some = set(year.inputFiles()), set(month.inputFiles())
    spans = [r for r in year.groupBy(F.input_file_name().alias("f"), "year_month_key").agg(F.min("date_key").alias("a"), F.max("date_key").alias("b")).collect()]
    assert all(r.a // 100 == r.b // 100 == r.year_month_key for r in spans)
    read = [r for r in spans if r.year_month_key == 199705]
    scan = next(x for x in plan(month).split("\n") if "FileScan" in x)
    assert re.search(r"PartitionFilters: \[.*year_month_key.*199705", scan)
    assert len(files) >= 12 and 1 <= len(read) <= len(files) / 6 and some <= set(star.fact_sales.inputFiles())


@pytest.mark.parametrize(
    "name",
    ["m_all_by_country_channel", "kpi_table", "calc_group", "ti_ytd_customers", "rpt_overview_kpis", "share_of_parent",
     "cohort_retention", "customer_features", "rfm_scores", "quality_checks", "stage_order_lines", "lift_at_k"],
)
def test_no_cross_joins_and_no_python(spark, name):
    text = plan(CATALOG[name](spark, SF_DIR))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "BatchEvalPython"):
        assert bad not in text


def test_hot_keys_are_split(spark, tmp_path):
    """A third of the line items on one order: the join's partition is read in pieces."""
    for name in ("region", "nation", "supplier", "part", "customer", "orders"):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    items = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    hot = items.withColumn("l_orderkey", F.when(F.col("l_partkey") % 3 == 0, 11).otherwise(F.col("l_orderkey")))
    hot.repartition(12).write.parquet(str(tmp_path / "lineitem.parquet"))
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
    }
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        df = bind_order_lines(spark, str(tmp_path))
        assert len(df.collect()) == items.count()
        assert "skew=true" in plan(df)
    finally:
        for k in small:
            spark.conf.unset(k)


def test_changed_input_is_built_anew(spark, tmp_path):
    for name in ("region", "nation", "supplier", "part", "customer", "orders"):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    items = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    items.limit(100).write.parquet(str(tmp_path / "lineitem.parquet"))
    first = open_warehouse(spark, str(tmp_path))
    assert open_warehouse(spark, str(tmp_path)) is first
    items.limit(200).write.mode("overwrite").parquet(str(tmp_path / "lineitem.parquet"))
    assert open_warehouse(spark, str(tmp_path)) is not first


@pytest.fixture
def shuffled_joins(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_texts_made_from_keys_do_not_travel(spark, shuffled_joins):
    """Order, customer and city names are made behind the last join of the line items."""
    top, *below = bind_order_lines(spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    for name in ("order_id", "customer_id", "city", "channel"):
        assert f" AS {name}#" in top
        assert not any(f" AS {name}#" in x for x in below)


def test_order_lines_of_a_customer_are_in_one_partition(spark, shuffled_joins):
    rows = [{"order_id": f"SO-{i // 3}", "customer_id": f"C{i // 3 % 20}", "sku": f"K{i % 17}", "category": f"A{i % 5}"} for i in range(300)]
    lines = order_lines(make_star(make_lines(spark, rows)))
    spread = lines.select("customer_id", F.spark_partition_id().alias("p")).distinct().groupBy("customer_id").count()
    assert lines.count() == 300 and {r["count"] for r in spread.collect()} == {1}


def test_customer_categories_travel_without_sums(spark):
    rows = [{"order_id": f"SO-{i}", "customer_id": f"C{i % 3}", "sku": f"K{i % 4}", "category": f"A{i % 4}"} for i in range(12)]
    found = customer_features(order_lines(make_star(make_lines(spark, rows))), "2024-06-30")
    assert sorted((r.customer_id, r.n_categories, r.frequency) for r in found.collect()) == [(f"C{i}", 4, 4) for i in range(3)]
    grouped = re.findall(r"Aggregate\(keys=\[([^\]]*)\], functions=\[([^\]]*)\]", plan(found))
    pairs = [functions for keys, functions in grouped if "customer_id" in keys and "category" in keys]
    assert pairs and not any(pairs)


def test_amounts_do_not_travel_through_the_fact_joins(spark, shuffled_joins):
    star = make_star(lines := make_lines(spark, [{"unit_price": 10, "quantity": 3, "unit_cost": 4, "discount_pct": "0.1"}]))
    fact = build_fact(lines, star.dim_customer, star.dim_store, star.dim_product)
    assert [(float(r.net_revenue), float(r.discount_amount), float(r.cost)) for r in fact.collect()] == [(27.0, 3.0, 12.0)]
    top, *below = build_fact(bind_order_lines(spark, SF_DIR), star.dim_customer, star.dim_store, star.dim_product)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    for name in ("net_revenue", "discount_amount", "cost"):
        assert f" AS {name}#" in top and not any(f" AS {name}#" in x for x in below)


def test_line_items_are_not_shuffled_to_stores(spark, shuffled_joins, monkeypatch):
    def keys():
        return re.findall(r"hashpartitioning\((\w+)#", plan(bind_order_lines(spark, SF_DIR)))

    assert "l_orderkey" in keys() and "l_partkey" in keys() and "l_suppkey" not in keys()
    monkeypatch.setattr("tillstar.sources.bound.BROADCAST_BYTES", 0)
    assert "l_suppkey" in keys()


def test_order_lines_of_a_run_are_not_joined_again(spark, shuffled_joins):
    """A line's product and customer were joined for the fact; members are the dimensions' own, and a narrowed star starts from its fact."""
    rows = [
        {"order_id": f"SO-{i // 2}", "customer_id": f"C{i % 5}", "segment": f"S{i % 3}", "sku": f"K{i % 4}", "category": f"A{i % 8}", "store_name": f"T{i % 2}"}
        for i in range(40)
    ]
    star = etl.run(make_lines(spark, rows)).star
    found, plain = order_lines(star), order_lines(replace(star, keyed=None))
    assert found.schema == plain.schema and sorted(found.collect()) == sorted(plain.collect()) and found.count() == 40
    assert {"product_key", "customer_key"} <= set(re.findall(r"hashpartitioning\((\w+)#", plan(plain)))
    assert not {"product_key", "customer_key"} & set(re.findall(r"hashpartitioning\((\w+)#", plan(found)))
    assert order_lines(star.with_stores(star.dim_store.filter("store_name = 'T0'"))).count() == 20


def test_amounts_do_not_travel_to_the_months(spark, tmp_path):
    star = make_star(lines := make_lines(spark, [{"unit_price": 10, "quantity": 3, "unit_cost": 4, "discount_pct": "0.1"}]))
    keyed, seen = stored_keys(keyed_lines(lines, star.dim_customer, star.dim_store, star.dim_product)), []
    write_gold({"fact_sales": keyed}, str(tmp_path), observe=lambda f: seen.append(f) or f, finish=fact_rows)
    fact = read_gold(spark, str(tmp_path), "fact_sales", "parquet")
    assert [(float(r.net_revenue), float(r.discount_amount), float(r.cost), r.year, r.year_month_key) for r in fact.collect()] == [(27.0, 3.0, 12.0, 2024, 202401)]
    above, below = seen[0]._jdf.queryExecution().optimizedPlan().toString().split("RebalancePartitions")
    for name in ("net_revenue", "discount_amount", "cost", "year"):
        assert f" AS {name}#" in above and f" AS {name}#" not in below


def test_fact_lines_are_not_shuffled_to_stores(spark, shuffled_joins, monkeypatch):
    star = make_star(lines := make_lines(spark, [{"store_name": f"T{i}"} for i in range(5)]))

    def text():
        return plan(build_fact(lines, star.dim_customer, star.dim_store, star.dim_product))

    assert "hashpartitioning(sku" in text() and "hashpartitioning(store_name" not in text()
    monkeypatch.setattr("tillstar.session.STORE_BYTES", 1 << 40)
    assert "hashpartitioning(store_name" in text()
