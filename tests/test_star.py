"""Staging, dimensions, fact, checks, files."""

import datetime as dt
import re

import pytest
from support import DEFAULTS, make_lines, make_star
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tillstar.operators import checks
from tillstar.operators.fact import in_period, line_amounts, orphan_keys, star_join
from tillstar.operators.staging import quarantined, stage
from tillstar.plans import etl
from tillstar.session import together
from tillstar.sources.files import (
    new_version,
    publish,
    published,
    read_cohorts,
    read_gold,
    read_header,
    read_order_lines,
    read_order_lines_quarantined,
    read_scores,
    security_map,
    write_gold,
    write_order_lines,
)
from tillstar.sources.schemas import GOLD, ORDER_LINES, RAW_ORDER_LINES
from tillstar.star import Star


def raw(spark, **change):
    row = {k: str(v) for k, v in {**DEFAULTS, **change}.items()}
    return spark.createDataFrame([tuple(row[f.name] for f in RAW_ORDER_LINES.fields)], RAW_ORDER_LINES)


def test_stage_trims_and_types(spark):
    df = stage(raw(spark, city="  Pune ", is_returned="true", quantity="3"))
    assert [f.dataType for f in df.schema] == [f.dataType for f in ORDER_LINES]
    row = df.first()
    assert row.city == "Pune" and row.is_returned is True and row.quantity == 3


def test_stage_fails_or_quarantines_bad_values(spark):
    bad = raw(spark, quantity="three")
    with pytest.raises(PySparkException):
        stage(bad).collect()
    good_rows, bad_rows = quarantined(stage(bad.union(raw(spark)), "quarantine"))
    assert good_rows.count() == 1 and good_rows.columns == ORDER_LINES.names
    assert bad_rows.first().bad_columns == ["quantity"]


def test_csv_round_trip_keeps_quotes_and_commas(spark, tmp_path):
    lines = make_lines(spark, [{"product_name": 'Pen, "blue"'}, {"order_id": "SO-2", "is_returned": True}])
    write_order_lines(lines, str(tmp_path / "raw"))
    back = stage(read_order_lines(spark, str(tmp_path / "raw")))
    assert sorted(back.collect()) == sorted(lines.collect())


def test_line_amounts_round_half_up(spark):
    row = line_amounts(make_lines(spark, [{"unit_price": "0.15", "discount_pct": "0.5", "quantity": 1}])).first()
    assert str(row.net_revenue) == "0.08" and str(row.discount_amount) == "0.08"


def test_calendar_is_dense_and_fiscal(spark):
    star = make_star(make_lines(spark, [{"order_date": "2023-03-31"}, {"order_date": "2024-04-01"}]))
    days = {r.date: r for r in star.dim_date.collect()}
    assert len(days) == 365 + 366
    assert days[dt.date(2023, 3, 31)].fiscal_year == 2023 and days[dt.date(2023, 4, 1)].fiscal_year == 2024
    assert days[dt.date(2024, 2, 29)].date_key == 20240229
    assert [days[dt.date(2024, 1, d)].is_weekend for d in (5, 6, 7, 8)] == [False, True, True, False]
    assert days[dt.date(2024, 2, 1)].month_name == "Feb" and days[dt.date(2024, 2, 1)].year_month == "2024-02"


def test_dimensions(spark):
    star = make_star(
        make_lines(
            spark,
            [
                {"customer_id": "C2", "signup_date": "2023-05-01", "sku": "K2", "unit_price": 5},
                {"customer_id": "C1", "country": "UAE", "state": "DU", "city": "Dubai"},
                {"customer_id": "C2", "signup_date": "2023-02-01", "sku": "K2", "unit_price": 7},
            ],
        )
    )
    customers = {r.customer_id: r for r in star.dim_customer.collect()}
    assert customers["C1"].customer_key == 1 and customers["C2"].customer_key == 2
    assert customers["C2"].signup_date == dt.date(2023, 2, 1)
    assert {(r.city, r.region, r.store_key) for r in star.dim_store.collect()} == {
        ("Pune", "Domestic", 1), ("Dubai", "International", 2),
    }
    assert {(r.sku, float(r.list_price), r.product_key) for r in star.dim_product.collect()} == {("K1", 100, 1), ("K2", 7, 2)}


def test_same_store_name_in_two_cities_does_not_multiply_lines(spark):
    stg = make_lines(spark, [{"city": "Pune"}, {"city": "Mumbai", "order_id": "SO-2"}])
    star = make_star(stg)
    assert star.fact_sales.count() == 2
    assert star_join(star).count() == 2
    assert star.fact_sales.select("store_key").distinct().count() == 2


def test_checks_pass_and_fail(spark):
    stg = make_lines(spark, [{}, {"order_id": "SO-2"}])
    star = make_star(stg)
    assert {r.check_name: r.failures for r in checks.run_checks(star, stg).collect()} == dict.fromkeys(checks.CHECKS, 0)
    more = stg.union(stg.limit(1))
    found = {r.check_name: r.failures for r in checks.run_checks(star, more).collect()}
    assert found[checks.ROW_PARITY] == 1 and found[checks.RECONCILES] == 10000
    with pytest.raises(checks.QualityCheckError, match="fact rows"):
        checks.dq_gate(checks.run_checks(star, more))
    assert orphan_keys(star.fact_sales, star.dim_date.filter("month <> 1"), "date_key").first().failures == 2
    doubled = star.dim_customer.union(star.dim_customer)
    assert checks.dq_duplicate_keys(doubled).first().failures == 1
    nameless = star.dim_customer.withColumn("customer_key", F.lit(None).cast("long"))
    assert checks.dq_duplicate_keys(nameless).first().failures == 1


def test_observed_checks_are_the_scanned_ones(spark):
    """Counted while writing: the same results, and only keys are read again."""
    rows = [{"order_id": f"SO-{i}", "customer_id": f"C{i % 5}", "quantity": None if i == 3 else -1 if i == 4 else i} for i in range(8)]
    stg = make_lines(spark, rows)
    star = make_star(stg)
    broken = Star(**{**star.tables(), "dim_store": star.dim_store.union(star.dim_store)})
    more = stg.union(stg.limit(2))
    fact = star.fact_sales.agg(*[c.alias(n) for n, c in checks.fact_metrics().items()]).first().asDict()
    staged = more.agg(*[c.alias(n) for n, c in checks.staging_metrics().items()]).first().asDict()
    scanned = checks.run_checks(broken, more).unionByName(checks.extended_checks(broken))
    found = checks.observed_checks(broken, fact, staged)
    as_dict = lambda df: {r.check_name: r.failures for r in df.collect()}
    assert as_dict(found) == as_dict(scanned) and any(as_dict(found).values())
    read = re.findall(r"ReadSchema: struct<([^>]*)>", found._jdf.queryExecution().executedPlan().toString())
    assert read and {c.split(":")[0] for r in read for c in r.split(",") if c} <= set(Star.KEYS.values())


def test_publishers_at_one_time(spark, tmp_path):
    """Nobody's version stays hidden behind an earlier one, also where two take the same number."""
    folder = str(tmp_path / "gold")
    marks = tmp_path / "gold" / "manifests"
    versions = [new_version(folder) for _ in range(6)]
    together(spark, *[lambda v=v: publish(spark, folder, v, keep=10) for v in versions])
    held = sorted(p.name for p in marks.iterdir() if not p.name.startswith("."))
    assert {n[10:] for n in held} == {v.rpartition("/")[2] for v in versions}  # all were published
    last = max(n[:9] for n in held)
    assert published(spark, folder).endswith(min(n[10:] for n in held if n[:9] == last))
    for name in ("0" * 12, "f" * 12):  # after a rival that took the number in between
        number = int(max(p.name for p in marks.iterdir() if not p.name.startswith("."))[:9]) + 1
        publish(spark, folder, f"{folder}/versions/{name}", keep=10)
        (marks / f"{number:09d}-777777777777").touch()
        assert published(spark, folder).endswith("777777777777" if name > "7" else name)
        publish(spark, folder, f"{folder}/versions/{name}1", keep=10)
        assert published(spark, folder).endswith(f"{name}1")


def test_empty_input_does_not_pass_the_gate(spark, tmp_path):
    with pytest.raises(checks.QualityCheckError, match="empty fact"):
        etl.run(make_lines(spark, []), str(tmp_path / "gold"))
    assert not [p for p in tmp_path.rglob("*") if p.is_file()]


def test_failed_run_leaves_the_published_version(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "gold")
    built = etl.run(make_lines(spark, [{}]), folder)
    opened = built.star.fact_sales
    monkeypatch.setattr(etl, "publish", lambda *a: (_ for _ in ()).throw(OSError("storage gone")))
    with pytest.raises(OSError, match="storage gone"):
        etl.run(make_lines(spark, [{"order_id": "new"}, {"order_id": "newer"}]), folder)
    assert [r.order_id for r in read_gold(spark, folder, "fact_sales", "parquet").collect()] == ["SO-1"]
    monkeypatch.undo()
    etl.run(make_lines(spark, [{"order_id": "new"}]), folder)
    assert [r.order_id for r in read_gold(spark, folder, "fact_sales", "parquet").collect()] == ["new"]
    assert [r.order_id for r in opened.collect()] == ["SO-1"]  # a reader of the old version goes on
    etl.run(make_lines(spark, [{"order_id": "last"}]), folder)
    assert len(list((tmp_path / "gold" / "versions").iterdir())) == 2


def test_malformed_rows_stop_the_run_or_are_set_aside(spark, tmp_path):
    path = str(tmp_path / "raw")
    write_order_lines(make_lines(spark, [{}, {"order_id": "SO-2"}]).coalesce(1), path)
    part = next((tmp_path / "raw").glob("part-*"))
    lines = part.read_text().splitlines()
    part.write_text("\n".join([*lines, ",".join(lines[1].split(",")[:15])]) + "\n")
    for crc in (tmp_path / "raw").glob(".*.crc"):
        crc.unlink()
    with pytest.raises((PySparkException, Py4JJavaError)):
        etl.run(read_order_lines(spark, path))
    good, bad = read_order_lines_quarantined(spark, path)
    assert good.count() == 2 and bad.count() == 1
    assert etl.run(good).star.fact_sales.count() == 2


def test_missing_values_do_not_pass_the_gate(spark):
    with pytest.raises(checks.QualityCheckError, match="missing quantity"):
        etl.run(make_lines(spark, [{}, {"order_id": "SO-2", "quantity": None}]))


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_run_exports_gold_with_declared_schema(spark, tmp_path, fmt):
    stg = make_lines(spark, [{}, {"order_id": "SO-2", "order_date": "2025-07-01", "brand": 'B "x", y'}])
    mapping = security_map(spark, [("a", "India"), ("a", "UAE")])
    folder = str(tmp_path / "gold")
    etl.run(make_lines(spark, [{"order_id": "old"}]), folder, security=mapping, fmt=fmt)
    built = etl.run(stg, folder, security=mapping, fmt=fmt)  # replaces the first export
    assert [p.name for p in tmp_path.iterdir()] == ["gold"]
    back = {n: read_gold(spark, folder, n, fmt) for n in [*built.star.tables(), "security_user_country"]}
    if fmt == "csv":
        found = checks.schema_contract({n: read_header(spark, published(spark, folder), n) for n in back})
        assert found.count() == sum(len(GOLD[n].names) for n in back) and found.filter("not ok").count() == 0
    for name, df in back.items():
        want = mapping if name == "security_user_country" else built.star.tables()[name]
        columns = GOLD[name].names
        assert sorted(df.select(columns).collect()) == sorted(want.select(columns).collect()), name


def test_schema_contract_reports_each_problem(spark):
    wrong = spark.createDataFrame([("a", "1")], "user_email string, extra string")
    found = {(r.column, r.declared, r.found, r.ok) for r in checks.schema_contract({"security_user_country": wrong}).collect()}
    assert found == {("user_email", True, True, True), ("country", True, False, False), ("extra", False, True, False)}
    texts = spark.createDataFrame([("2024Q1", "1", "x"), ("2024Q1", None, "2.5")], "cohort string, months_since_first string, retention_pct string")
    rows = {r.column: r.bad_values for r in checks.schema_contract({"cohort_retention": texts}).collect()}
    assert rows == {"cohort": 0, "months_since_first": 0, "retention_pct": 1}


def test_relationship_contract(spark):
    star = make_star(make_lines(spark, [{}]))
    scores = spark.createDataFrame([("C1",), ("C9",)], "customer_id string")
    rows = {(r.relationship, r.kind): r.failures for r in checks.relationship_contract(star.tables() | {"customer_scores": scores}).collect()}
    assert rows.pop(("customer_scores.customer_id -> dim_customer.customer_id", "orphans")) == 1
    assert set(rows.values()) == {0}
    with pytest.raises(ValueError):
        checks.relationship_contract(star.tables() | {"fact_sales": star.fact_sales.drop("date_key")})


def test_read_scores_and_cohorts(spark, tmp_path):
    scores = spark.createDataFrame(
        [("C1", 1, 2, 3, "At risk", 1, 10, 2, 5.5, 0.7, "High"), ("C2", 1, 2, 3, "At risk", 0, 10, 2, 5.5, 0.1, "Low")],
        GOLD["customer_scores"],
    )
    cohorts = spark.createDataFrame([("2023Q1", 0, 100.0), ("2023Q1", 1, 45.5)], GOLD["cohort_retention"])
    write_gold({"customer_scores": scores, "cohort_retention": cohorts}, str(tmp_path), "csv")
    assert {r.churn_risk: r.risk_order for r in read_scores(spark, str(tmp_path)).collect()} == {"High": 1, "Low": 3}
    assert {r.months_since_first: r.retention for r in read_cohorts(spark, str(tmp_path)).collect()} == {0: 1.0, 1: 0.455}


def test_period_filters(spark):
    dates = ["1999-03-31", "1999-04-01", "1999-12-31", "2000-01-01", "2000-03-31", "2000-04-01"]
    star = make_star(make_lines(spark, [{"order_date": d, "order_id": d} for d in dates]))

    def got(**k):
        return sorted(r.order_id for r in in_period(star.fact_sales, **k).collect())

    assert got(year=1999) == dates[:3]
    assert got(fy=2000) == dates[1:5]
    assert got(between=("1999-12-31", "2000-03-31")) == dates[2:5]
    with pytest.raises(ValueError):
        in_period(star.fact_sales, year=1, fy=2)
