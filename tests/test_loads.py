from datetime import date, timedelta

import pytest
from data import rows

from tidemart.loads import (
    LoadWindow,
    evolve,
    filter_window,
    load_append,
    load_incremental,
    load_merge,
    load_replace,
    load_summary,
    next_start,
    plan_load,
)
from tidemart.specs import TableSpec

SPEC = TableSpec("rates", ("rate_date", "quote"), cursor="rate_date")
SCHEMA = "rate_date DATE, quote STRING, rate DOUBLE"
INITIAL = date(2026, 1, 1)
FIRST = [("2026-01-10", "USD", 1.0), ("2026-02-10", "USD", 2.0)]


def frame(spark, data):
    return spark.createDataFrame([(date.fromisoformat(d), q, r) for d, q, r in data], SCHEMA)


def load(spark, wh, data, **options):
    options.setdefault("overlap_days", 0)
    return load_incremental(wh, SPEC, lambda _: frame(spark, data), initial=INITIAL, **options)


def table(wh, spec=SPEC):
    return {(str(r.rate_date), r.quote): r.rate for r in wh.read("raw", spec.name).collect()}


def test_without_lag_an_older_row_is_dropped(spark, warehouse):
    load(spark, warehouse, FIRST)
    load(spark, warehouse, [("2026-01-10", "USD", 99.0)])
    assert table(warehouse) == {("2026-01-10", "USD"): 1.0, ("2026-02-10", "USD"): 2.0}


def test_with_lag_a_row_inside_the_window_enters(spark, warehouse):
    load(spark, warehouse, FIRST)
    window = load(spark, warehouse, [("2026-02-05", "USD", 55.0)], overlap_days=30)
    assert window.start == date(2026, 1, 11)
    assert table(warehouse)["2026-02-05", "USD"] == 55.0
    assert warehouse.state("raw", "rates").cursor == "2026-02-10"


def test_row_at_the_cursor_is_corrected(spark, warehouse):
    load(spark, warehouse, FIRST)
    load(spark, warehouse, [("2026-02-10", "USD", 3.0), ("2026-02-11", "USD", 4.0)])
    assert table(warehouse)["2026-02-10", "USD"] == 3.0
    assert len(table(warehouse)) == 3


def test_backfill_keeps_the_cursor(spark, warehouse):
    load(spark, warehouse, FIRST)
    old = [("2020-03-01", "USD", 7.0), ("2020-05-01", "USD", 8.0)]
    bounds = dict(date_from=date(2020, 1, 1), date_to=date(2020, 3, 1))
    window = load(spark, warehouse, old, **bounds)
    assert window == LoadWindow(date(2020, 1, 1), date(2020, 3, 1), moves_cursor=False)
    assert ("2020-03-01", "USD") in table(warehouse)  # the end is inclusive
    assert ("2020-05-01", "USD") not in table(warehouse)
    assert plan_load(warehouse, SPEC, INITIAL, 30).start == date(2026, 1, 11)


def test_backfill_into_an_empty_table_leaves_no_cursor(spark, warehouse):
    load(spark, warehouse, FIRST, date_from=date(2026, 1, 1), date_to=date(2026, 12, 31))
    assert warehouse.state("raw", "rates").cursor is None
    assert plan_load(warehouse, SPEC, INITIAL, 30).start == INITIAL


def test_open_backfill_ends_today(spark, warehouse):
    window = plan_load(warehouse, SPEC, date_from=date(2020, 1, 1), today=date(2026, 5, 1))
    assert (window.start, window.end) == (date(2020, 1, 1), date(2026, 5, 1))


def test_overlap_zero_differs_from_default_and_long_reaches_further(spark, warehouse):
    load(spark, warehouse, FIRST)
    hwm = date(2026, 2, 10)
    assert plan_load(warehouse, SPEC, overlap_days=0).start == hwm
    assert plan_load(warehouse, SPEC).start == hwm - timedelta(days=7)
    assert plan_load(warehouse, SPEC, overlap_days=365).start == hwm - timedelta(days=365)
    assert next_start(None, INITIAL, 30) == INITIAL


def test_empty_target_loads_the_history(spark, warehouse):
    assert plan_load(warehouse, SPEC) == LoadWindow(date(1999, 1, 4), None, refresh=True)
    load(spark, warehouse, FIRST)
    load_merge(warehouse, frame(spark, []), SPEC, refresh=True)  # rows gone, log kept
    assert warehouse.is_empty("raw", "rates")
    assert plan_load(warehouse, SPEC).refresh


def test_full_refresh_forgets_rows_and_cursor_of_this_table_only(spark, warehouse):
    other = TableSpec("other", SPEC.keys, SPEC.cursor)
    load_merge(warehouse, frame(spark, FIRST), other)
    load(spark, warehouse, FIRST)
    load(spark, warehouse, [("2026-01-05", "USD", 5.0)], full_refresh=True)
    assert table(warehouse) == {("2026-01-05", "USD"): 5.0}
    assert warehouse.state("raw", "rates").cursor == "2026-01-05"
    assert len(table(warehouse, other)) == 2


def test_merge_touches_only_its_months(spark, warehouse):
    load(spark, warehouse, FIRST)
    before = warehouse.state("raw", "rates").folders
    load(spark, warehouse, [("2026-02-11", "USD", 3.0)])
    after = warehouse.state("raw", "rates").folders
    assert before["202601"] == after["202601"]
    assert before["202602"] != after["202602"]
    assert len(table(warehouse)) == 3


def test_merge_is_idempotent_and_collapses_repeats(spark, warehouse):
    batch = frame(spark, [("2026-01-10", "USD", 1.0), ("2026-01-10", "USD", 5.0), FIRST[1]])
    for _ in range(2):
        load_merge(warehouse, batch, SPEC)
    assert table(warehouse) == {("2026-01-10", "USD"): 5.0, ("2026-02-10", "USD"): 2.0}


def test_merge_by_hash_bucket(spark, warehouse):
    spec = TableSpec("by_id", ("id",), buckets=4)
    load_merge(warehouse, spark.range(100).selectExpr("id", "id AS v"), spec)
    load_merge(warehouse, spark.range(90, 110).selectExpr("id", "-id AS v"), spec)
    got = dict(rows(warehouse.read("raw", "by_id")))
    assert got == {i: (i if i < 90 else -i) for i in range(110)}


def test_null_keys_and_null_cursors_do_not_multiply(spark, warehouse):
    batch = spark.createDataFrame([(None, "USD", 1.0), (INITIAL, None, 2.0)], SCHEMA)
    for _ in range(2):
        load_merge(warehouse, batch, SPEC)
    assert warehouse.read("raw", "rates").count() == 2


def test_job_that_dies_leaves_the_table_as_it_was(spark, warehouse):
    load(spark, warehouse, FIRST)
    broken = frame(spark, [("2026-02-11", "USD", 1.0)]).selectExpr(
        "rate_date", "quote", "CAST(raise_error('source gone') AS DOUBLE) AS rate"
    )
    with pytest.raises(Exception, match="source gone"):
        load_merge(warehouse, broken, SPEC)
    with pytest.raises(Exception, match="source gone"):
        load_replace(warehouse, broken, SPEC)
    assert table(warehouse) == {(d, q): r for d, q, r in FIRST}
    load(spark, warehouse, [("2026-02-11", "USD", 3.0)])
    assert len(table(warehouse)) == 3


def test_replace_and_append(spark, warehouse):
    for _ in range(2):
        load_replace(warehouse, frame(spark, FIRST), SPEC)
    assert warehouse.read("raw", "rates").count() == 2
    load_append(warehouse, frame(spark, [("2026-03-01", "USD", 3.0)]), SPEC)
    assert warehouse.read("raw", "rates").count() == 3
    load_replace(warehouse, frame(spark, FIRST[:1]), SPEC)
    assert warehouse.read("raw", "rates").count() == 1


def test_new_columns_join_and_numbers_widen(spark, warehouse):
    spec = TableSpec("evolving", ("id",), buckets=8)
    load_merge(warehouse, spark.sql("SELECT CAST(id AS INT) id, CAST(1.5 AS FLOAT) x FROM range(20)"), spec)
    load_merge(warehouse, spark.sql("SELECT id, CAST(2.5 AS DOUBLE) x, 'new' note FROM range(18, 22)"), spec)
    df = warehouse.read("raw", "evolving")
    assert dict(df.dtypes) == {"id": "bigint", "x": "double", "note": "string"}
    got = {r.id: (r.x, r.note) for r in df.collect()}
    assert got == {i: ((1.5, None) if i < 18 else (2.5, "new")) for i in range(22)}


def test_incompatible_type_goes_to_a_side_column(spark, warehouse):
    spec = TableSpec("evolving", ("id",), buckets=2)
    load_merge(warehouse, spark.sql("SELECT id, 1 v FROM range(2)"), spec)
    load_merge(warehouse, spark.sql("SELECT id, 'n/a' v FROM range(1, 3)"), spec)
    assert rows(warehouse.read("raw", "evolving")) == [(0, 1, None), (1, None, "n/a"), (2, None, "n/a")]


def test_decimal_widening(spark):
    target = spark.sql("SELECT CAST(1 AS DECIMAL(10,2)) v").schema
    schema, batch = evolve(target, spark.sql("SELECT CAST(1 AS DECIMAL(9,4)) v"))
    assert schema["v"].dataType.simpleString() == "decimal(12,4)"
    assert batch.schema == schema


def test_window_filter_is_pushed_to_the_scan(spark, warehouse):
    load(spark, warehouse, FIRST)
    window = LoadWindow(date(2026, 2, 1), date(2026, 2, 28))
    df = filter_window(warehouse.read("raw", "rates"), "rate_date", window)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(rate_date,2026-02-01)" in plan
    assert df.count() == 1


def test_summary_lists_every_load(spark, warehouse):
    load(spark, warehouse, FIRST)
    load(spark, warehouse, [("2026-02-11", "USD", 3.0)])
    got = load_summary(warehouse, [SPEC]).orderBy("seq").collect()
    assert [(r.action, r.n_rows) for r in got] == [("refresh", 2), ("merge", 1)]
    assert len({r.load_id for r in got}) == 2


def test_missing_table_is_an_error(warehouse):
    assert not warehouse.exists("raw", "nothing")
    with pytest.raises(LookupError):
        warehouse.read("raw", "nothing")


def test_other_bucket_counts_keep_every_key(spark, warehouse):
    def spec(buckets):
        return TableSpec("items", ("k",), buckets=buckets)

    rows_of = lambda n, v: spark.range(n).selectExpr("id AS k", f"{v} AS v")
    load_merge(warehouse, rows_of(1000, 1), spec(16))
    load_merge(warehouse, rows_of(5, 2), spec(24))
    got = {r.k: r.v for r in warehouse.read("raw", "items").collect()}
    assert warehouse.read("raw", "items").count() == 1000
    assert got == {k: 2 if k < 5 else 1 for k in range(1000)}


@pytest.mark.parametrize("first", [load_replace, load_append])
def test_merge_onto_a_table_loaded_otherwise(spark, warehouse, first):
    first(warehouse, frame(spark, FIRST), SPEC)
    load_merge(warehouse, frame(spark, [("2026-01-10", "USD", 9.0)]), SPEC)
    assert warehouse.read("raw", "rates").count() == 2
    assert table(warehouse) == {("2026-01-10", "USD"): 9.0, ("2026-02-10", "USD"): 2.0}


def test_last_day_of_a_time_window_counts_to_its_end(spark):
    df = spark.sql(
        "SELECT explode(array(TIMESTAMP '2026-01-02 10:00', TIMESTAMP '2026-01-03 00:00')) AS at"
    )
    window = LoadWindow(date(2026, 1, 1), date(2026, 1, 2))
    assert [r["at"].day for r in filter_window(df, "at", window).collect()] == [2]
