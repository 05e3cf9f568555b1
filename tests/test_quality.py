from datetime import date, datetime

import pytest
from data import rows
from pyspark.sql import functions as F

from tidemart.loads import audit_rows, store_failures
from tidemart.operators import (
    CheckFailed,
    between,
    check_results,
    custom,
    enforce,
    freshness,
    length_equals,
    no_future,
    not_null,
    overall_status,
    raw_profile,
    reciprocal_coherence,
    relationships,
    session_timezone,
    unique,
    unique_combination,
)
from tidemart.specs import TableSpec


@pytest.fixture(scope="module")
def df(spark):
    data = [
        (1, "EUR", date(2026, 1, 1), 2.0, 0.5),
        (1, "USD", date(2026, 1, 2), 4.0, 0.25),
        (2, "GBP?", date(2026, 1, 3), 0.0, 1.0),
        (None, None, date(2026, 1, 3), None, None),
        (None, "EUR", date(2026, 1, 1), 3.0, 0.3333),
    ]
    return spark.createDataFrame(data, "id INT, code STRING, d DATE, x DOUBLE, inv DOUBLE")


def test_each_check_finds_its_rows(spark, df):
    parents = spark.createDataFrame([("EUR",)], "code STRING")
    assert not_null("id").violations(df).count() == 2
    assert rows(unique("id").violations(df)) == [(1, 2)]
    assert rows(unique_combination(["code", "d"]).violations(df)) == [("EUR", date(2026, 1, 1), 2)]
    assert rows(between("x", 0, 3).violations(df), "x") == [(4.0,)]
    assert rows(between("x", 0, strictly=True).violations(df), "x") == [(0.0,)]
    assert rows(length_equals("code", 3).violations(df), "code") == [("GBP?",)]
    assert rows(relationships("code", parents, "code").violations(df)) == [("GBP?", 1), ("USD", 1)]
    assert rows(reciprocal_coherence("x", "inv").violations(df), "x") == [(0.0,), (3.0,)]
    late = no_future("d", date(2026, 1, 2)).violations(df)
    assert rows(late) == [(date(2026, 1, 3), 2)]
    assert session_timezone("UTC").violations(df).count() == 0
    assert rows(session_timezone("Asia/Tokyo").violations(df)) == [("UTC", "Asia/Tokyo")]
    assert custom("big", lambda t: t.filter("x > 3")).violations(df).count() == 1


def test_results_and_status(spark, df):
    parents = spark.createDataFrame([("EUR",)], "code STRING")
    checks = [
        not_null("d", "error"),
        not_null("id"),
        unique("id", "error"),
        relationships("code", parents, "code"),
    ]
    assert rows(check_results(df, checks)) == [
        ("not_null_d", "error", 0, "ok"),
        ("not_null_id", "warn", 2, "degraded"),
        ("relationships_code", "warn", 2, "degraded"),
        ("unique_id", "error", 1, "failed"),
    ]
    assert overall_status([]) == "ok"
    assert overall_status(["ok", "degraded"]) == "degraded"
    assert overall_status(["degraded", "failed", "ok"]) == "failed"


def test_gate_stores_failures_and_raises_on_errors_only(df, warehouse):
    store = store_failures(warehouse, "t", "r1")
    results = enforce(df, [not_null("id"), not_null("d", "error")], store)
    assert {r["status"] for r in results} == {"ok", "degraded"}
    assert rows(audit_rows(warehouse), "table", "check", "run") == [("t", "not_null_id", "r1")] * 2
    with pytest.raises(CheckFailed, match="unique_id"):
        enforce(df, [unique("id", "error")], store)
    assert audit_rows(warehouse).filter("check = 'unique_id'").count() == 1


def test_audit_keeps_runs_and_rules_of_one_name_apart(df, warehouse):
    assert audit_rows(warehouse).count() == 0
    checks = [between("x", 0, 3), between("x", 3, 9), unique("id")]
    for run in ("r1", "r2"):
        enforce(df, checks, store_failures(warehouse, "t", run, ["code", "d"]))
    kept = audit_rows(warehouse)
    assert rows(kept.groupBy("run", "check").count()) == [
        (run, check, n)
        for run in ("r1", "r2")
        for check, n in (("between_x#2", 2), ("between_x", 1), ("unique_id", 1))
    ]
    # The same row has the same id in each run; a group of rows has one of its own.
    assert rows(kept.groupBy("check", "row_id").count(), "count") == [(2,)] * 4
    one = kept.filter("table = 't' AND check = 'unique_id' AND run = 'r2'")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and len(set(one.inputFiles())) == len(one.inputFiles())
    assert [r.row for r in one.collect()] == ['{"id":1,"n_records":2}']


def test_rules_of_a_table_take_two_scans(spark, df, tmp_path):
    df.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    parents = spark.createDataFrame([("EUR",), (None,)], "code STRING")
    others = spark.createDataFrame([(1,), (1,)], "id INT")
    checks = [
        not_null("id"),
        between("x", 0, 3),
        custom("big", F.col("x") > 3),
        unique("id"),
        unique("code"),
        unique_combination(["code", "d"]),
        unique_combination(["id", "code"]),
        relationships("code", parents, "code"),
        relationships("code", others.select(F.col("id").cast("string")), "id"),
        relationships("id", others, "id"),
        no_future("d", date(2026, 1, 2)),
    ]
    results = check_results(stored, checks)
    plan = results._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2
    one_by_one = [c.violations(df) for c in checks]
    expected = [
        (sum(r[c.weight] for r in v.collect()) if c.weight else v.count())
        for c, v in zip(checks, one_by_one, strict=True)
    ]
    assert [r.n_violations for r in results.collect()] == expected
    assert expected == [2, 1, 1, 1, 1, 1, 0, 2, 4, 1, 1]


def test_a_session_in_another_zone_moves_days(spark):
    events = spark.sql("SELECT explode(array(TIMESTAMP '2026-01-01 01:00', TIMESTAMP '2026-01-01 12:00')) AS at")
    check = session_timezone("America/Argentina/Buenos_Aires", at="at")
    assert rows(check.violations(events), "session_day", "expected_day", "n_records") == [
        (date(2026, 1, 1), date(2025, 12, 31), 1)
    ]
    assert check_results(events, [check]).first().n_violations == 1
    assert check_results(events, [session_timezone("UTC", at="at")]).first().n_violations == 0


@pytest.mark.parametrize(
    ("as_of", "age", "status"),
    [
        (datetime(2026, 1, 2, 6), 30, "pass"),
        (datetime(2026, 1, 2, 6, 1), 30, "warn"),
        (datetime(2026, 1, 4, 0), 72, "warn"),
        (datetime(2026, 1, 4, 0, 0, 1), 72, "error"),
    ],
)
def test_freshness(spark, as_of, age, status):
    df = spark.createDataFrame([(datetime(2026, 1, 1),)], "_ingested_at TIMESTAMP")
    got = freshness(df, as_of=as_of).first()
    assert (got.age_hours, got.status) == (age, status)


def test_freshness_of_nothing_is_an_error(spark):
    df = spark.createDataFrame([], "_ingested_at TIMESTAMP")
    assert freshness(df).first().status == "error"


def test_raw_profile(spark, df):
    dated = df.withColumn("d", F.when(F.col("id").isNotNull(), F.col("d")))
    tables = {
        TableSpec("facts", ("code", "d"), cursor="d"): dated.union(dated.limit(1)),
        TableSpec("catalog", ("code",)): df.select("code").distinct(),
        TableSpec("absent", ("id",)): None,
    }
    assert rows(raw_profile(spark, tables)) == [
        ("absent", True, None, None, None, None, None, 1),
        ("catalog", False, 4, 0, None, None, None, 0),
        ("facts", False, 6, 1, "2026-01-01", "2026-01-03", 2, 2),
    ]
