"""Global order without a global window."""

import random

import pytest
from pyspark.sql import functions as F

from tillstar import session
from tillstar.operators.keys import with_dense_key, with_dense_rank, with_running_sums


@pytest.fixture(params=["true", "false"], autouse=True)
def merging(spark, request):
    """With and without AQE merging the ranges of these small inputs."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", request.param)
    yield request.param
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_dense_key_equals_global_row_number(spark, merging):
    rng = random.Random(1)
    values = [(rng.choice([0, 0, 0, 5, 9]), f"id{i:05d}") for i in range(3000)]
    rng.shuffle(values)
    df = spark.createDataFrame(values, "v int, id string").repartition(7)
    keyed = with_dense_key(df, [F.desc("v"), "id"], "k")
    want = {x: i + 1 for i, x in enumerate(sorted(values, key=lambda t: (-t[0], t[1])))}
    got = {(r.v, r.id): r.k for r in keyed.collect()}
    assert got == want
    assert (len(keyed.inputFiles()) > 1) == (merging == "false")
    assert keyed.schema["k"].dataType.simpleString() == "bigint"


def test_dense_key_of_nothing(spark):
    assert with_dense_key(spark.createDataFrame([], "id string"), ["id"], "k").collect() == []


def test_running_sums_over_partitions(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(500)], "i int, v int").repartition(5)
    got = {r.i: (r.s, r.n) for r in with_running_sums(df.withColumn("one", F.lit(1)), ["i"], {"s": "v", "n": "one"}, "t").collect()}
    total = 0
    for i in range(500):
        total += i % 3
        assert got[i] == (total, i + 1)


def test_dense_rank(spark):
    df = spark.createDataFrame([("a", 5), ("b", 5), ("c", 3), ("d", 9), ("e", 0)], "m string, v int")
    ranks = {r.m: r.rank for r in with_dense_rank(df, "v", "rank").collect()}
    assert ranks == {"d": 1, "a": 2, "b": 2, "c": 3, "e": 4}


def test_drop_scratch_removes_this_applications_tables_only(spark, tmp_path, monkeypatch):
    monkeypatch.setitem(session._ROOTS, spark.sparkContext.applicationId, str(tmp_path))
    (tmp_path / "other").mkdir()
    assert session.materialize(spark.range(3), "t").count() == 3
    session.drop_scratch(spark)
    assert [p.name for p in tmp_path.iterdir() if p.name != "tillstar"] == ["other"]
    assert list((tmp_path / "tillstar").iterdir()) == []


def test_jobs_run_together_in_order_and_raise(spark):
    assert session.together(spark, lambda: spark.range(5).count(), lambda: "b") == [5, "b"]
    with pytest.raises(ZeroDivisionError):
        session.together(spark, lambda: 1 / 0, lambda: 1)
