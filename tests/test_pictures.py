"""Catalog pictures: the newest holds, and repeated codes have one open version."""

import json
import os
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import functions as F

from tidemart.loads import load_replace, load_snapshot
from tidemart.loads.dispositions import open_versions
from tidemart.operators import step_snapshot
from tidemart.plans import load_catalog
from tidemart.plans.jobs import missing_weekdays
from tidemart.specs import TableSpec, catalog_spec, rates_spec


def test_catalog_is_the_picture_that_landed_last(warehouse, tmp_path):
    for k, picture in enumerate([{"USD": "old", "HRK": "Kuna"}, {"USD": "Dollar"}]):
        file = tmp_path / f"{'ba'[k]}.json"  # names in the other order
        file.write_text(json.dumps(picture))
        os.utime(file, (1_700_000_000 + k, 1_700_000_000 + k))
    load_catalog(warehouse, "fx", str(tmp_path))
    rows = warehouse.read("raw", catalog_spec("fx").name).collect()
    assert [(r.code, r.name) for r in rows] == [("USD", "Dollar")]


def test_repeated_codes_have_one_open_version(spark, warehouse):
    spec = TableSpec("history", ("code",), layer="scd2")
    batch = spark.createDataFrame([("USD", "a"), ("USD", "b"), ("EUR", "e")], "code string, name string")
    for k in range(4):
        at = datetime(2026, 1, 1, tzinfo=UTC) + timedelta(days=k)
        load_snapshot(warehouse, batch, spec, ["name"], at)
    rows = warehouse.read("scd2", "history").collect()
    assert sorted((r.code, r.dbt_valid_to) for r in rows) == [("EUR", None), ("USD", None)]


def test_a_range_without_any_quote_is_a_gap(spark, warehouse):
    quotes = spark.createDataFrame(
        [(date(2025, 1, 6), "EUR", "USD", 1.0)], "date date, base string, currency string, rate double"
    )
    load_replace(warehouse, quotes, rates_spec("fx"))
    gaps = missing_weekdays(warehouse, "fx", date(2026, 1, 5), date(2026, 1, 10)).collect()
    assert [(r.base, r.n_days) for r in gaps] == [("EUR", 5)]
    load_replace(warehouse, quotes.limit(0), rates_spec("fx"))
    days = (date(2026, 1, 5), date(2026, 1, 10))
    assert missing_weekdays(warehouse, "fx", *days).count() == 0
    gaps = missing_weekdays(warehouse, "fx", *days, base="EUR").collect()
    assert [(r.base, r.n_days) for r in gaps] == [("EUR", 5)]


def test_snapshot_shuffles_the_picture_but_not_the_history(spark, warehouse):
    spec = TableSpec("history", ("code",), layer="scd2", buckets=8)
    picture = spark.range(500).selectExpr("concat('C', id) AS code", "'a' AS name")
    start = datetime(2026, 1, 1, tzinfo=UTC)
    load_snapshot(warehouse, picture, spec, ["name"], start)
    state = warehouse.state("scd2", "history")
    later = picture.filter("code <> 'C7'").withColumn("name", F.expr("if(code = 'C8', 'b', name)"))
    schema = warehouse.read("scd2", "history").schema
    with open_versions(warehouse, spec, schema, state.folders["open"]) as old:
        step = step_snapshot(old, later, ["code"], ["name"], start, buckets=8)
        plan = step._jdf.queryExecution().executedPlan().toString()
    history, new = plan.split("SortMergeJoin")[1].split("FileScan")[0], plan
    assert "Bucketed: true" in plan and "Exchange" not in history
    assert new.count("Exchange hashpartitioning") == 2  # the picture's keys, once made unique

    at = start + timedelta(days=1)
    load_snapshot(warehouse, later.union(spark.sql("SELECT NULL, 'x'")), spec, ["name"], at)
    rows = warehouse.read("scd2", "history").collect()
    assert len(rows) == 501 and sum(r.dbt_valid_to is None for r in rows) == 499
    assert sorted((r.code, r.name) for r in rows if r.dbt_valid_to) == [("C7", "a"), ("C8", "a")]
    assert [r.n_dropped for r in warehouse.log("scd2", "history").orderBy("seq").collect()] == [0, 1]
    # One file a bucket, and no table left in the catalog.
    files = spark.read.parquet(warehouse.state("scd2", "history").folders["open"]).inputFiles()
    assert len(files) == 8
    assert not [t for t in spark.catalog.listTables() if "versions" in t.name]


def test_a_history_in_other_buckets_is_read_whole(spark, warehouse):
    picture = spark.range(50).selectExpr("concat('C', id) AS code", "'a' AS name")
    for k, buckets in enumerate((4, 6, 6)):
        spec = TableSpec("history", ("code",), layer="scd2", buckets=buckets)
        load_snapshot(warehouse, picture, spec, ["name"], datetime(2026, 1, 1 + k, tzinfo=UTC))
    rows = warehouse.read("scd2", "history").collect()
    assert len(rows) == 50 and {r.dbt_valid_from.day for r in rows} == {1}
