"""What is shuffled and written on the way from the raw lines to the reports: lines in buckets, files that go, sets that are not repeated."""

import re

import pytest
from support import make_lines, make_star
from pyspark.sql import functions as F

from tillstar.operators.distincts import DistinctCube
from tillstar.operators.fact import keyed_lines, order_lines, placed_lines, with_customers
from tillstar.operators.features import customer_features
from tillstar.plans import etl
from tillstar.session import bucket_count, materialize, materialize_buckets, tune
from tillstar.sources.files import read_gold, write_gold


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def dealt(df):
    return re.findall(r"hashpartitioning\((\w+)#", plan(df))


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, old)


def lines(spark):
    rows = [
        {"order_id": f"SO-{i // 2}", "customer_id": f"C{i % 5}", "segment": f"S{i % 3}", "sku": f"K{i % 4}", "category": f"A{i % 8}", "order_date": f"2024-0{1 + i % 9}-11"}
        for i in range(40)
    ]
    return make_lines(spark, rows)


def test_staged_lines_are_not_shuffled_to_products(spark, no_broadcast):
    built = etl.run(lines(spark))
    star = built.star
    assert dealt(placed_lines(built.stg, star.dim_store, star.dim_product)).count("sku") == 1  # the products' side
    found, plain = (keyed_lines(s, star.dim_customer, star.dim_store, star.dim_product) for s in (built.stg, lines(spark)))
    assert dealt(plain).count("sku") == 2
    assert sorted(found.select(*plain.columns).collect()) == sorted(plain.collect()) and found.count() == 40


def test_order_lines_of_a_run_are_not_shuffled_to_customers(spark, no_broadcast):
    star, plain = etl.run(lines(spark)).star, make_star(lines(spark))
    per_customer = with_customers(star.keyed, star.dim_customer).groupBy("customer_id").agg(F.count("*").alias("n"))
    assert dealt(per_customer) == ["customer_id"]  # the dimension's side
    assert sorted(per_customer.collect()) == [(f"C{i}", 8) for i in range(5)]
    features = [sorted(customer_features(order_lines(s), "2024-12-31").collect()) for s in (star, plain)]
    assert features[0] == features[1] and len(features[0]) == 4  # one never has the smallest id of an order


def test_a_hot_key_is_read_without_buckets(spark, no_broadcast, monkeypatch):
    df = spark.range(200).select((F.col("id") * 0).alias("k"), "id")
    table, dealt_out = materialize_buckets(df, "even", "id", 4)
    assert dealt_out and dealt(table.groupBy("id").count()) == []
    monkeypatch.setattr("tillstar.session.HOT_BYTES", 0)
    monkeypatch.setattr("tillstar.session.HOT_BUCKET", 2)
    table, dealt_out = materialize_buckets(df, "hot", "k", 4, ("k", "id"))
    assert not dealt_out and dealt(table.groupBy("k").count()) == ["k"]
    assert sorted(table.collect()) == sorted(df.collect()) and table.dtypes == df.dtypes
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("tillstar_")]


def test_a_run_with_a_hot_customer_gives_the_same_lines(spark, monkeypatch):
    monkeypatch.setattr("tillstar.session.HOT_BYTES", -1)
    monkeypatch.setattr("tillstar.session.HOT_BUCKET", 0)
    star = etl.run(lines(spark)).star
    assert star.keyed is None
    assert sorted(order_lines(star).collect()) == sorted(order_lines(make_star(lines(spark))).collect())


def test_buckets_follow_the_input(spark):
    parts, cores = int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism
    assert bucket_count(spark, 0) == parts
    for size in (1, 1 << 30, 10 << 30):
        n = bucket_count(spark, size)
        assert (n % parts == 0 or parts % n == 0) and n >= min(parts, cores) and n * (16 << 20) >= min(size, parts * (16 << 20))


def test_shuffled_files_go_with_their_query(spark):
    tune(spark)
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return {x.rpartition("/")[2] for x in disk.getAllFiles().mkString("\n").split("\n") if "shuffle_" in x}

    before = files()
    materialize(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counted")
    assert files() <= before


def test_sets_are_not_repeated_for_trailing_periods(spark):
    found = DistinctCube.build(make_star(lines(spark)), ["category"]).trailing(["category"], 3)
    text = found._jdf.queryExecution().optimizedPlan().toString()
    repeats = [x for x in text.split("\n") if "Generate explode" in x]
    assert repeats and not any("bits#" in x or "word#" in x for x in repeats)


@pytest.mark.parametrize("months", [1, 2, 3, 12])
def test_trailing_counts(spark, months):
    """Orders and customers that come back within, at the edge of and behind the period; a null member; months without sales."""
    seen = [(1, "C1", "A"), (2, "C1", "A"), (2, "C2", "A"), (5, "C1", "A"), (6, "C3", "B"), (8, "C1", "A"), (8, "C2", None), (9, "C2", None), (12, "C3", "A")]
    rows = [{"order_id": f"SO-{i // 2}", "customer_id": c, "category": a, "sku": f"K{a}", "order_date": f"2024-{m:02d}-05"} for i, (m, c, a) in enumerate(seen)]
    found = DistinctCube.build(make_star(make_lines(spark, rows)), ["category"]).trailing(["category"], months)
    want = {}
    for i, (m, c, a) in enumerate(seen):
        for t in range(m, min(m + months, 13)):
            orders, customers = want.setdefault((a, 202400 + t), (set(), set()))
            orders.add(i // 2)
            customers.add(c)
    assert {(r.category, r.month): (r.orders, r.active_customers) for r in found.collect()} == {k: (len(o), len(c)) for k, (o, c) in want.items()}


def test_csv_export_may_be_compressed(spark, tmp_path):
    star = make_star(lines(spark))
    write_gold(star.tables(), str(tmp_path), "csv", compression="gzip")
    assert list((tmp_path / "fact_sales").glob("*.csv.gz")) and not list((tmp_path / "fact_sales").glob("*.csv"))
    for name, df in star.tables().items():
        assert sorted(map(str, read_gold(spark, str(tmp_path), name).collect())) == sorted(map(str, df.select(*read_gold(spark, str(tmp_path), name).columns).collect()))
