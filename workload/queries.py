"""One query per operator: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart import operators as ops
from tidemart import work_dir
from tidemart.functions import calendar_columns, instant_to_local, reciprocal, utc_to_local
from tidemart.loads import audit_rows as stored_failures
from tidemart.loads import (
    load_append,
    load_incremental,
    load_merge,
    load_replace,
    load_snapshot,
    load_summary,
    materialize,
    store_failures,
    write_replace,
)
from tidemart.plans import (
    build_marts,
    currency_activity,
    daily_quotes,
    dim_currency,
    dim_currency_history,
    dim_date,
    fact_quotes,
    load_catalog,
    load_rates,
    monthly_report,
    stage_catalog,
    stage_quotes,
)
from tidemart.session import DISPLAY_TIMEZONE
from tidemart.sources import (
    calendar,
    read_catalog_payload,
    read_quote_payloads,
    read_seed,
    select_symbols,
    with_metadata,
    with_row_id,
)
from tidemart.specs import MARTS, RAW, REJECTS, TableSpec, catalog_spec, rates_spec
from tidemart.streaming import stream_merge
from workload import inputs
from workload.inputs import LOADED, SOURCE, new_warehouse, portable, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = lambda spark, sf_dir: portable(fn(spark, sf_dir))
    return fn


# -- staging, measures, dimensions, fact, report --------------------------------


@query
def stage_messy_quotes(spark, sf_dir):
    lines = inputs.line_quotes(spark, sf_dir).select(
        "date",
        F.concat(F.lit(" "), F.lower("base")).alias("base"),
        F.concat(F.lower("currency"), F.lit("  ")).alias("currency"),
        (F.col("rate") - 20000).cast("decimal(20,8)").alias("rate"),
        F.lit(1).cast("decimal(20,8)").alias("amount"),
    )
    return stage_quotes(with_metadata(lines, SOURCE, LOADED))


@query
def stage_catalog_blank_to_null(spark, sf_dir):
    names = F.when(F.col("c_acctbal") < 0, "   ").otherwise(F.concat(F.lit(" "), "c_name"))
    rows = table(spark, sf_dir, "customer").select(
        F.concat(F.lit(" c"), F.col("c_custkey").cast("string")).alias("code"), names.alias("name")
    )
    return stage_catalog(with_metadata(rows, SOURCE, LOADED))


@query
def previous_publication(spark, sf_dir):
    daily = daily_quotes(inputs.quotes(spark, sf_dir)).drop("cargado_en", "origen_dato")
    return daily.withColumn("cotizacion_inversa", F.round("cotizacion_inversa", 12))


@query
def calendar_attributes(spark, sf_dir):
    """Calendar attributes of every shipping day, with the items shipped then."""
    items = table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").cast("date").alias("fecha"))
    per_day = items.groupBy("fecha").agg(F.count(F.lit(1)).alias("n_items"))
    return per_day.select(*calendar_columns(F.col("fecha")), "n_items")


@query
def calendar_days_without_rows(spark, sf_dir):
    """Every day of the dimension, days without shipments included."""
    items = table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").cast("date").alias("fecha"))
    per_day = items.groupBy("fecha").agg(F.count(F.lit(1)).alias("n"))
    days = dim_date(spark, date(1994, 1, 1), date(2003, 1, 1))
    joined = days.join(per_day, "fecha", "left")
    return joined.select("clave_fecha", F.coalesce("n", F.lit(0)).alias("n_items"))


@query
def entity_activity(spark, sf_dir):
    return currency_activity(inputs.quotes(spark, sf_dir), inputs.catalog(spark, sf_dir))


@query
def dim_entity_seed_default(spark, sf_dir):
    activity = currency_activity(inputs.quotes(spark, sf_dir), inputs.catalog(spark, sf_dir))
    return dim_currency(activity, inputs.region_seed(spark, sf_dir))


def _days(spark, sf_dir) -> tuple[date, date]:
    """First shipping day of the data, and the day after the last."""
    day = F.col("l_shipdate").cast("date")
    first, last = table(spark, sf_dir, "lineitem").agg(F.min(day), F.max(day)).first()
    return first, last + timedelta(days=1)


def _star(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """``(fact, dates)`` over stored raw and dimension tables, as the jobs build them.

    The calendar leaves out the last year of the data, whose quotes drop from the fact.
    """
    wh = new_warehouse(spark)
    write_replace(wh, inputs.raw_rates(spark, sf_dir), RAW, "rates")
    quotes = stage_quotes(wh.read(RAW, "rates"))
    first, end = _days(spark, sf_dir)
    last_year = date((end - timedelta(days=1)).year, 1, 1)
    dates = materialize(wh, dim_date(spark, first, last_year), MARTS, "dim_fecha")
    activity = currency_activity(quotes, inputs.catalog(spark, sf_dir))
    currencies = dim_currency(activity, inputs.region_seed(spark, sf_dir))
    currencies = materialize(wh, currencies, MARTS, "dim_moneda")
    return fact_quotes(daily_quotes(quotes), dates, currencies), dates


@query
def fact_star(spark, sf_dir):
    fact, _ = _star(spark, sf_dir)
    return fact.withColumn("cotizacion_inversa", F.round("cotizacion_inversa", 12))


@query
def monthly_quote_report(spark, sf_dir):
    return monthly_report(*_star(spark, sf_dir))


# -- sources --------------------------------------------------------------------


@query
def flatten_payload(spark, sf_dir):
    lines = inputs.line_quotes(spark, sf_dir).withColumn("amount", F.lit(100).cast("decimal(20,8)"))
    return read_quote_payloads(spark, inputs.land_payloads(spark, lines), "EUR")


@query
def catalog_payload(spark, sf_dir):
    entry = F.create_map(F.col("c_custkey").cast("string"), F.col("c_name"))
    path = f"{work_dir(spark)}/catalog"
    table(spark, sf_dir, "customer").select(F.to_json(entry).alias("value")).write.text(path)
    return read_catalog_payload(spark, path)


@query
def seed_leading_zeros(spark, sf_dir):
    path = f"{work_dir(spark)}/seed"
    table(spark, sf_dir, "customer").select(
        F.lpad(F.col("c_custkey").cast("string"), 12, "0").alias("code"),
        "c_name",
        F.col("c_mktsegment").alias("region"),
    ).write.option("header", True).csv(path)
    return read_seed(spark, path, "code STRING, c_name STRING, region STRING")


@query
def row_metadata(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return with_metadata(rows, "tpch.orders", LOADED)


@query
def row_id_sha256(spark, sf_dir):
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    rows = inputs.orders(spark, sf_dir).select(
        "o_orderkey", "o_custkey", "o_orderdate", status.alias("status")
    )
    return with_row_id(rows, ["o_custkey", "status", "o_orderdate"])


@query
def symbols_filter(spark, sf_dir):
    rates = inputs.raw_rates(spark, sf_dir).select("date", "base", "currency", "rate")
    return select_symbols(rates, ["S1", "S2", "S3", "S5", "S8"])


@query
def local_time(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select("event_id", utc_to_local(F.col("ts"), DISPLAY_TIMEZONE).alias("local_ts"))


# -- loads ----------------------------------------------------------------------

ORDERS = TableSpec("orders", ("o_orderdate", "o_orderkey"), cursor="o_orderdate")
FIRST_UNTIL = date(1997, 12, 31)


@query
def load_replace_twice(spark, sf_dir):
    wh, rows = new_warehouse(spark), inputs.orders(spark, sf_dir)
    load_replace(wh, rows.withColumn("o_totalprice", F.lit(0.0)), ORDERS)
    load_replace(wh, rows, ORDERS)
    return wh.read("raw", "orders")


@query
def load_append_batches(spark, sf_dir):
    wh, rows = new_warehouse(spark), inputs.orders(spark, sf_dir)
    load_append(wh, rows.filter("o_orderstatus = 'P'"), ORDERS)
    load_append(wh, rows.filter("o_orderstatus <> 'P'"), ORDERS)
    return wh.read("raw", "orders")


LINES = TableSpec("lineitem", ("l_orderkey", "l_linenumber"), order_by=("l_shipdate",), buckets=16)


def _lines(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_suppkey", "l_quantity", "l_returnflag"
    )


@query
def merge_upsert(spark, sf_dir):
    """All line items, then corrections of the returned ones and some new keys."""
    wh, lines = new_warehouse(spark), _lines(spark, sf_dir)
    load_merge(wh, lines, LINES)
    returned = lines.filter("l_returnflag = 'R'")
    corrected = returned.withColumn("l_quantity", F.col("l_quantity") + 100)
    added = returned.withColumn("l_linenumber", F.col("l_linenumber") + 10)
    load_merge(wh, corrected.unionByName(added), LINES)
    return wh.read("raw", "lineitem")


@query
def merge_idempotent(spark, sf_dir):
    """Rows after one load, after two, and how many differ."""
    wh, lines = new_warehouse(spark), _lines(spark, sf_dir)
    load_merge(wh, lines, LINES)
    once = wh.read("raw", "lineitem")
    load_merge(wh, lines, LINES)
    twice = wh.read("raw", "lineitem")
    sides = once.withColumn("n", F.lit(1)).unionByName(twice.withColumn("n", F.lit(-1)))
    by_row = sides.groupBy(*once.columns).agg(
        F.count_if(F.col("n") > 0).alias("once"), F.count_if(F.col("n") < 0).alias("twice")
    )
    return by_row.agg(
        F.sum("once").alias("rows_once"),
        F.sum("twice").alias("rows_twice"),
        F.count_if(F.col("once") != F.col("twice")).alias("rows_changed"),
    )


@query
def latest_line_per_key(spark, sf_dir):
    return ops.latest_by_key(_lines(spark, sf_dir), LINES.keys, LINES.order_by)


@query
def schema_evolution(spark, sf_dir):
    """A second batch with a wider key type and one more column."""
    wh, spec = new_warehouse(spark), TableSpec("customer", ("c_custkey",), buckets=16)
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    load_merge(wh, rows.select(F.col("c_custkey").cast("int").alias("c_custkey"), "c_name"), spec)
    load_merge(wh, rows.filter("c_acctbal < 0").select("c_custkey", "c_name", "c_mktsegment"), spec)
    return wh.read("raw", "customer")


def _two_loads(spark, sf_dir, **second: object) -> DataFrame:
    """The first years, then every order with a corrected price."""
    wh, rows = new_warehouse(spark), inputs.orders(spark, sf_dir)
    initial = date(1990, 1, 1)
    first = rows.filter(F.col("o_orderdate") <= F.lit(FIRST_UNTIL))
    corrected = rows.withColumn("o_totalprice", F.col("o_totalprice") + 1000)
    load_incremental(wh, ORDERS, lambda _: first, initial=initial, overlap_days=0)
    load_incremental(wh, ORDERS, lambda _: corrected, initial=initial, **second)
    return wh.read("raw", "orders")


@query
def incremental_no_lag(spark, sf_dir):
    return _two_loads(spark, sf_dir, overlap_days=0)


@query
def incremental_lag_days(spark, sf_dir):
    return _two_loads(spark, sf_dir, overlap_days=30)


@query
def reconcile_long_lag(spark, sf_dir):
    return _two_loads(spark, sf_dir, overlap_days=365)


@query
def bounded_backfill(spark, sf_dir):
    return _two_loads(spark, sf_dir, date_from=date(1996, 1, 1), date_to=date(1996, 6, 30))


@query
def full_refresh(spark, sf_dir):
    return _two_loads(spark, sf_dir, full_refresh=True)


@query
def auto_history(spark, sf_dir):
    """A table emptied behind the cursor's back is loaded from the start again."""
    wh, rows = new_warehouse(spark), inputs.orders(spark, sf_dir)
    load_incremental(wh, ORDERS, lambda _: rows, initial=date(1990, 1, 1))
    load_replace(wh, rows.limit(0), ORDERS)
    load_incremental(wh, ORDERS, lambda _: rows, initial=date(1996, 1, 1))
    return wh.read("raw", "orders")


@query
def summary_of_loads(spark, sf_dir):
    wh, rows = new_warehouse(spark), inputs.orders(spark, sf_dir)
    customers = TableSpec("customer", ("c_custkey",))
    load_merge(wh, rows.filter(F.col("o_orderdate") <= F.lit(FIRST_UNTIL)), ORDERS)
    load_merge(wh, rows, ORDERS)
    load_replace(wh, table(spark, sf_dir, "customer"), customers)
    return load_summary(wh, [ORDERS, customers]).select("table", "seq", "action", "n_rows")


RATES = TableSpec("rates", ("date", "base", "currency"), cursor="date", required=("rate",))
RATE_COLUMNS = ("date", "base", "currency", "rate")


@query
def lower_correction(spark, sf_dir):
    """A later file corrects quotes downwards: loaded with the first, after it, in a stream."""
    daily = inputs.daily_quotes(spark, sf_dir)
    halved = daily.withColumn("rate", (F.col("rate") / 2).cast("decimal(20,8)"))
    root = f"{work_dir(spark)}/landing"
    inputs.land_payloads(spark, daily, f"{root}/a")
    inputs.land_payloads(spark, halved.filter(F.dayofmonth("date") % 3 == 0), f"{root}/b")
    both, since = f"{root}/*", date(1990, 1, 1)
    table_name = rates_spec(SOURCE).name

    together, one_by_one, stream = (new_warehouse(spark) for _ in range(3))
    load_rates(together, SOURCE, both, "EUR", LOADED, initial=since)
    load_rates(one_by_one, SOURCE, f"{root}/a", "EUR", LOADED, initial=since)
    load_rates(one_by_one, SOURCE, both, "EUR", LOADED, overlap_days=36500)
    stream_merge(
        stream, rates_spec(SOURCE), both, f"{stream.root}/checkpoint", "EUR", SOURCE, initial=since
    )
    parts = [
        wh.read(RAW, table_name).select(F.lit(how).alias("how"), *RATE_COLUMNS)
        for how, wh in (("together", together), ("one by one", one_by_one), ("stream", stream))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def catalog_picture_in_parts(spark, sf_dir):
    """A catalog that Spark wrote in several files, beside an older one."""
    landing = f"{work_dir(spark)}/catalog"
    suppliers = table(spark, sf_dir, "supplier")
    for age, picture in enumerate((suppliers, suppliers.filter("s_acctbal > 0"))):
        entry = F.create_map(
            F.concat(F.lit("S"), F.col("s_suppkey").cast("string")),
            F.concat("s_name", F.lit(f" {age}")),
        )
        lines = picture.repartition(5, "s_suppkey").select(F.to_json(entry).alias("value"))
        lines.write.mode("append").text(landing)
    wh = new_warehouse(spark)
    load_catalog(wh, SOURCE, landing, LOADED)
    return wh.read(RAW, catalog_spec(SOURCE).name).select("code", "name")


def _stored_and_rejected(wh, spec, columns) -> DataFrame:
    stored = wh.read(spec.layer, spec.name).select(*columns)
    rejected = wh.read(REJECTS, spec.name).select(*columns, "reject_reason")
    return stored.withColumn("reject_reason", F.lit(None).cast("string")).unionByName(rejected)


@query
def rejected_rows(spark, sf_dir):
    """Every row of a bounded load: stored, or kept with why it wasn't."""
    wh = new_warehouse(spark)
    key = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderkey"))
    day = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate"))
    price = F.when(F.col("o_custkey") % 5 != 0, F.col("o_totalprice"))
    rows = inputs.orders(spark, sf_dir).withColumns(
        {"o_orderkey": key, "o_orderdate": day, "o_totalprice": price}
    )
    spec = replace(ORDERS, required=("o_totalprice",))
    bounds = dict(date_from=date(1996, 1, 1), date_to=date(1997, 6, 30))
    load_incremental(wh, spec, lambda _: rows, **bounds)
    return _stored_and_rejected(wh, spec, [*rows.columns])


@query
def stream_late_rows(spark, sf_dir):
    """Two runs of small batches; the second brings corrections, most of them too late."""
    daily = inputs.daily_quotes(spark, sf_dir)
    wh, root = new_warehouse(spark), f"{work_dir(spark)}/landing"
    corrected = daily.filter(F.dayofmonth("date") % 2 == 0).withColumn("rate", F.col("rate") + 1)
    corrected = corrected.withColumn("rate", F.col("rate").cast("decimal(20,8)"))
    runs = (daily.filter(F.col("date") <= F.lit(FIRST_UNTIL)), corrected)
    for name, landed in zip("ab", runs, strict=True):
        inputs.land_payloads(spark, landed.repartition(3, "currency"), f"{root}/{name}")
        stream_merge(
            wh,
            RATES,
            f"{root}/*",
            checkpoint=f"{wh.root}/checkpoint",
            base="EUR",
            source=SOURCE,
            overlap_days=30,
            initial=date(1990, 1, 1),
            max_files_per_trigger=1,
        )
    return _stored_and_rejected(wh, RATES, RATE_COLUMNS)


@query
def schema_evolution_decimals(spark, sf_dir):
    """Decimals that no common type holds keep all their digits, each type in its column."""
    wh, spec = new_warehouse(spark), TableSpec("customer", ("c_custkey",), buckets=4)
    rows = table(spark, sf_dir, "customer")
    share = F.col("c_custkey").cast("decimal(12,0)") * F.lit("1.2345678912").cast("decimal(11,10)")
    rows = rows.select("c_custkey", share.alias("share"))
    for part, kind in enumerate(("decimal(38,2)", "decimal(18,8)", "decimal(14,10)")):
        batch = rows.filter(F.col("c_custkey") % 3 == part)
        cast = F.col("share").try_cast(kind)
        fits = cast.isNotNull() | F.col("share").isNull()
        load_merge(wh, batch.filter(fits).select("c_custkey", cast.alias("share")), spec)
        # Shares too large for this type, if there are any, keep the type of the product.
        large = batch.filter(~fits)
        if not large.isEmpty():
            load_merge(wh, large, spec)
    return wh.read(RAW, "customer")


@query
def merge_after_replace(spark, sf_dir):
    """A table replaced as a whole, then merged into by key."""
    wh, rows = new_warehouse(spark), inputs.orders(spark, sf_dir)
    load_replace(wh, rows.filter("o_orderstatus <> 'O'"), ORDERS)
    load_merge(wh, rows.withColumn("o_totalprice", F.col("o_totalprice") + 1000), ORDERS)
    return wh.read(RAW, "orders")


@query
def merge_after_bucket_change(spark, sf_dir):
    """A table dealt into more buckets by its second load."""
    wh, lines = new_warehouse(spark), _lines(spark, sf_dir)
    load_merge(wh, lines, LINES)
    returned = lines.filter("l_returnflag = 'R'")
    corrected = returned.withColumn("l_quantity", F.col("l_quantity") + 100)
    load_merge(wh, corrected, replace(LINES, buckets=24))
    return wh.read(RAW, "lineitem")


@query
def stream_merged_payloads(spark, sf_dir):
    """Replies arriving as files, merged by key in a stream."""
    landing = inputs.land_payloads(spark, inputs.daily_quotes(spark, sf_dir))
    wh = new_warehouse(spark)
    stream_merge(
        wh,
        RATES,
        landing,
        checkpoint=f"{wh.root}/checkpoint",
        base="EUR",
        source=SOURCE,
        overlap_days=36500,
        initial=date(1990, 1, 1),
    )
    return wh.read("raw", "rates").select("date", "base", "currency", "rate", "amount")


@query
def landed_files_to_report(spark, sf_dir):
    """The whole chain: landed replies, raw tables, checked marts, monthly report."""
    wh = new_warehouse(spark)
    lines = inputs.line_quotes(spark, sf_dir).withColumn("amount", F.lit(1).cast("decimal(20,8)"))
    # Of a day's replies the one with the highest rate was fetched last.
    lines = lines.withColumn("fetched_at", F.timestamp_seconds(F.col("rate") * 100))
    landing = inputs.land_payloads(spark, lines, packing="gzip")  # else the largest files of the run
    load_rates(wh, SOURCE, landing, "EUR", LOADED, initial=date(1990, 1, 1))
    catalog = table(spark, sf_dir, "supplier").filter("s_acctbal > 0")
    code = F.concat(F.lit("s"), F.col("s_suppkey").cast("string"))
    path = f"{wh.root}/landing/catalog"
    picture = catalog.select(F.to_json(F.create_map(code, F.col("s_name"))).alias("value"))
    picture.coalesce(1).write.text(path)  # one file, as a source answers
    load_catalog(wh, SOURCE, path, LOADED)
    first, end = _days(spark, sf_dir)
    marts = build_marts(
        wh,
        SOURCE,
        snapshot_at=LOADED,
        today=date(2026, 1, 7),
        calendar_start=first,
        calendar_end=end,
        seed=inputs.region_seed(spark, sf_dir),
    )
    return marts["rpt_cotizacion_mensual"]


@query
def incremental_mart_refresh(spark, sf_dir):
    """Marts of most quotes, then corrections and what was missing; changed months only."""
    wh, spec = new_warehouse(spark), rates_spec(SOURCE)
    rates = inputs.raw_rates(spark, sf_dir)
    last = F.last_day("date") == F.col("date")
    missing = F.year("date") * 12 + F.month("date") == 1997 * 12 + 5
    named = inputs.raw_catalog(spark, sf_dir).filter("trim(name) <> ''")
    load_replace(wh, named, catalog_spec(SOURCE))
    first, end = _days(spark, sf_dir)
    options = dict(
        today=end,
        calendar_start=first,
        calendar_end=end,
        seed=inputs.region_seed(spark, sf_dir),
    )
    load_merge(wh, rates.filter(~missing), spec)
    build_marts(wh, SOURCE, LOADED, **options)
    raised = rates.withColumn("rate", (F.col("rate") + 1000).cast("decimal(20,8)"))
    load_merge(wh, raised.filter(last & (F.month("date") == 2)).unionByName(rates.filter(missing)), spec)
    return build_marts(wh, SOURCE, LOADED, changed_only=True, **options)["rpt_cotizacion_mensual"]


# -- windows and gaps -----------------------------------------------------------


@query
def windows_per_customer(spark, sf_dir):
    ranges = (
        inputs.orders(spark, sf_dir)
        .groupBy("o_custkey")
        .agg(F.min("o_orderdate").alias("range_start"), F.max("o_orderdate").alias("range_end"))
    )
    return ops.plan_windows(ranges, "range_start", "range_end", max_days=90)


@query
def gaps_per_entity(spark, sf_dir):
    weekdays = calendar(spark, *_days(spark, sf_dir), "day").filter(F.weekday("day") < 5)
    quotes = inputs.line_quotes(spark, sf_dir)
    codes = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("currency")
    )
    in_debt = table(spark, sf_dir, "supplier").filter("s_acctbal < 0").select(
        F.concat(F.lit("X"), F.col("s_suppkey").cast("string")).alias("currency")
    )
    return ops.find_gaps(quotes, ["currency"], "date", weekdays, "day", codes.union(in_debt))


# -- history --------------------------------------------------------------------

T1 = datetime(1996, 6, 1, tzinfo=UTC)
T2 = datetime(1998, 1, 1, 12, tzinfo=UTC)
T3 = datetime(2000, 1, 1, 18, 30, tzinfo=UTC)
CUSTOMERS = TableSpec("customer_history", ("c_custkey",), layer="scd2")


def _pictures(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """The customer catalog, and a later picture: one segment renamed, debtors gone."""
    full = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    renamed = F.when(F.col("c_mktsegment") == "BUILDING", "BUILDERS").otherwise(F.col("c_mktsegment"))
    later = full.filter("c_acctbal >= 0").withColumn("c_mktsegment", renamed)
    return full, later


def _empty_history(spark) -> DataFrame:
    return spark.createDataFrame(
        [],
        "c_custkey BIGINT, c_mktsegment STRING, dbt_valid_from TIMESTAMP, dbt_valid_to TIMESTAMP",
    )


def _history(spark, sf_dir, steps, hard_deletes=True) -> DataFrame:
    history = _empty_history(spark)
    for at, batch in steps:
        history = ops.apply_snapshot(
            history, batch, ["c_custkey"], ["c_mktsegment"], at, hard_deletes
        )
    return history


@query
def scd2_check(spark, sf_dir):
    full, later = _pictures(spark, sf_dir)
    return _history(spark, sf_dir, [(T1, full), (T2, later)], hard_deletes=False)


@query
def scd2_hard_delete(spark, sf_dir):
    full, later = _pictures(spark, sf_dir)
    return _history(spark, sf_dir, [(T1, full), (T2, later)])


def _stored_history(spark, sf_dir) -> DataFrame:
    wh = new_warehouse(spark)
    full, later = _pictures(spark, sf_dir)
    for at, batch in [(T1, full), (T2, later), (T3, full), (T3, full)]:
        load_snapshot(wh, batch, CUSTOMERS, ["c_mktsegment"], at)
    return wh.read("scd2", CUSTOMERS.name)


@query
def scd2_return(spark, sf_dir):
    """Four stored snapshots; the last one changes nothing."""
    return _stored_history(spark, sf_dir)


@query
def scd2_repeated_keys(spark, sf_dir):
    """Three stored snapshots of pictures that list many keys twice, with other names."""
    wh = new_warehouse(spark)
    full, later = _pictures(spark, sf_dir)
    for at, batch in [(T1, full), (T2, later), (T3, full)]:
        # Of a key's names the last in order counts.
        twice = batch.filter("c_custkey % 3 = 0").withColumn("c_mktsegment", F.lit("A segment"))
        load_snapshot(wh, batch.unionByName(twice), CUSTOMERS, ["c_mktsegment"], at)
    return wh.read("scd2", CUSTOMERS.name)


@query
def history_dim(spark, sf_dir):
    full, later = _pictures(spark, sf_dir)
    history = _history(spark, sf_dir, [(T1, full), (T2, later)])
    return dim_currency_history(
        history.select(
            F.col("c_custkey").cast("string").alias("codigo_moneda"),
            F.col("c_mktsegment").alias("nombre_moneda"),
            "dbt_valid_from",
            "dbt_valid_to",
        )
    )


@query
def asof_segment(spark, sf_dir):
    """Each order with its customer's segment on the day of the order."""
    history = _stored_history(spark, sf_dir).select(
        F.col("c_custkey").alias("o_custkey"),
        "c_mktsegment",
        instant_to_local(F.col("dbt_valid_from"), "UTC").alias("valid_from"),
        instant_to_local(F.col("dbt_valid_to"), "UTC").alias("valid_to"),
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return ops.asof_lookup(
        orders,
        history,
        ["o_custkey"],
        "o_orderdate",
        "valid_from",
        "valid_to",
        ["c_mktsegment"],
        period="year",
    )


@query
def versions_in_force(spark, sf_dir):
    """The catalog as it was at one moment."""
    full, later = _pictures(spark, sf_dir)
    history = _history(spark, sf_dir, [(T1, full), (T2, later)])
    moment = datetime(1999, 1, 1, tzinfo=UTC)
    then = ops.valid_at(history, moment, "dbt_valid_from", "dbt_valid_to")
    return then.select("c_custkey", "c_mktsegment")


# -- checks ---------------------------------------------------------------------


@query
def check_not_null(spark, sf_dir):
    known = F.when(F.col("o_orderstatus") != "P", F.col("o_custkey"))
    orders = inputs.orders(spark, sf_dir).withColumn("o_custkey", known)
    return ops.not_null("o_custkey").violations(orders).select("o_orderkey", "o_orderstatus")


@query
def check_unique(spark, sf_dir):
    return ops.unique("l_orderkey").violations(table(spark, sf_dir, "lineitem"))


@query
def check_unique_combination(spark, sf_dir):
    check = ops.unique_combination(["l_orderkey", "l_linenumber"])
    return check.violations(table(spark, sf_dir, "lineitem"))


@query
def check_between(spark, sf_dir):
    check = ops.between("l_quantity", 5, 45, strictly=True)
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return check.violations(lines)


@query
def check_length(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return ops.length_equals("c_mktsegment", 9).violations(customers)


@query
def check_relationships(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier").filter("s_acctbal > 2000")
    check = ops.relationships("l_suppkey", suppliers, "s_suppkey")
    return check.violations(table(spark, sf_dir, "lineitem"))


def _rounded_inverse(value: Column) -> Column:
    return F.round(reciprocal(value), 8)


@query
def check_reciprocal(spark, sf_dir):
    """Inverses rounded to eight decimals fail; unrounded ones do not."""
    rates = inputs.raw_rates(spark, sf_dir).select("date", "base", "currency", "rate")
    exact = rates.withColumn("inverse", reciprocal(F.col("rate")))
    rounded = rates.withColumn("inverse", _rounded_inverse(F.col("rate")))
    check = ops.reciprocal_coherence("rate", "inverse")
    failing = check.violations(exact.unionByName(rounded))
    return failing.select("date", "base", "currency", "rate", F.round("inverse", 8).alias("inverse"))


@query
def check_future(spark, sf_dir):
    lines = inputs.line_quotes(spark, sf_dir)
    return ops.no_future("date", date(1999, 6, 1)).violations(lines)


@query
def freshness_status(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    by_type = None
    for as_of in (datetime(2024, 1, 31), datetime(2024, 2, 1, 18), datetime(2024, 3, 1)):
        one = ops.freshness(events, "ts", as_of)
        by_type = one if by_type is None else by_type.unionByName(one)
    return by_type


def _line_checks(spark, sf_dir) -> list[ops.Check]:
    suppliers = table(spark, sf_dir, "supplier").filter("s_acctbal > 2000")
    return [
        ops.not_null("l_orderkey", severity="error"),
        ops.not_null("l_shipdate"),
        ops.between("l_quantity", 1, 50),
        ops.between("l_discount", 0, 0.05),
        ops.length_equals("l_returnflag", 1),
        ops.unique_combination(["l_orderkey", "l_linenumber"], severity="error"),
        ops.relationships("l_suppkey", suppliers, "s_suppkey"),
        ops.no_future("l_shipdate", date(2000, 1, 1)),
        ops.session_timezone(spark.conf.get("spark.sql.session.timeZone")),
        ops.custom("heavy_discount", F.col("l_discount") * F.col("l_extendedprice") > 9000),
    ]


@query
def severity_gate(spark, sf_dir):
    return ops.check_results(table(spark, sf_dir, "lineitem"), _line_checks(spark, sf_dir))


@query
def check_session_timezone(spark, sf_dir):
    """Days that a session in another zone would count wrongly."""
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    check = ops.session_timezone(DISPLAY_TIMEZONE, at="ts")
    return check.violations(table(session, sf_dir, "events"))


@query
def audit_rows(spark, sf_dir):
    """Failing rows of two runs, read back from the audit table."""
    wh = new_warehouse(spark)
    lines = table(spark, sf_dir, "lineitem")
    checks = [
        ops.between("l_discount", 0, 0.05),
        ops.between("l_discount", 0.02, 0.1),  # of the same name
        ops.unique_combination(["l_orderkey", "l_linenumber"]),
    ]
    for run, part in (("odd", "l_orderkey % 2 = 1"), ("all", "TRUE")):
        store = store_failures(wh, "lineitem", run, ["l_orderkey", "l_linenumber"])
        ops.enforce(lines.filter(part), checks, store)
    fields = F.from_json("row", "l_orderkey BIGINT, l_linenumber INT, l_discount DOUBLE, n_records BIGINT")
    found = stored_failures(wh).withColumn("fields", fields)
    key = F.struct(F.col("fields.l_orderkey").alias("l_orderkey"), F.col("fields.l_linenumber").alias("l_linenumber"))
    same = F.col("row_id") == F.sha2(F.to_json(key), 256)
    return found.select("run", "check", "fields.*", same.alias("id_is_of_key"))


@query
def raw_profile(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn("day", F.col("l_shipdate").cast("date"))
    known = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate"))
    tables = {
        TableSpec("lineitem", ("l_orderkey", "l_linenumber"), cursor="day"): lines,
        TableSpec("orders", ("o_orderkey",), cursor="o_orderdate"): inputs.orders(
            spark, sf_dir
        ).withColumn("o_orderdate", known),
        TableSpec("customer", ("c_custkey",)): table(spark, sf_dir, "customer"),
        TableSpec("nowhere", ("id",)): None,
    }
    return ops.raw_profile(spark, tables)
