"""A refresh of the changed months equals a full build."""

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from data import SOURCE, raw_catalog, rows
from pyspark.sql import functions as F

from tidemart.loads import Warehouse, load_merge, load_replace
from tidemart.operators import CheckFailed, bucket_ends, custom, with_previous
from tidemart.plans import build_marts
from tidemart.plans.refresh import MadeOf, changed_months
from tidemart.specs import catalog_spec, rates_spec

AT = datetime(2026, 1, 7, 12, 0)
SPEC = rates_spec(SOURCE)
OPTIONS = dict(today=date(2026, 1, 7), calendar_end=date(2028, 1, 1))


def quotes(spark, data):
    schema = "date DATE, base STRING, currency STRING, rate DECIMAL(20,8), amount DECIMAL(20,8)"
    full = [(d, b, c, Decimal(str(r)), Decimal(1)) for d, b, c, r in data]
    df = spark.createDataFrame(full, schema)
    return df.withColumns(
        {"_ingested_at": F.lit("2026-01-07 12:00:00").cast("timestamp"), "_source": F.lit("s")}
    )


def history():
    """Two dense pairs, one with long gaps, and one that has a single quote."""
    rng = random.Random(4)
    days = [date(2024, 1, 1) + timedelta(days=n) for n in range(0, 600, 3)]
    out = [(d, "EUR", c, round(rng.uniform(1, 9), 4)) for d in days for c in ("USD", "BRL")]
    out += [(d, "USD", "GRD", round(rng.uniform(1, 9), 4)) for d in days[::37]]
    return [*out, (date(2024, 2, 29), "EUR", "IDR", 5.0)]


def marts_of(wh):
    tables = ("fct_cotizacion", "rpt_cotizacion_mensual", "dim_moneda")
    return {t: rows(wh.read("marts", t)) for t in tables}


def folders(wh, table):
    return wh.state("marts", table).folders


def test_refreshed_months_equal_a_full_build(spark, warehouse, tmp_path):
    load_merge(warehouse, quotes(spark, history()), SPEC)
    load_replace(warehouse, raw_catalog(spark), catalog_spec(SOURCE))
    build_marts(warehouse, SOURCE, AT, **OPTIONS)
    before = folders(warehouse, "fct_cotizacion")
    assert len(before) == 20 and marts_of(warehouse)["fct_cotizacion"]

    gap = date(2024, 1, 1) + timedelta(days=3 * 37)
    steps = [
        # The last quote of March, which April begins with; one of a pair whose next quote
        # is months away; a month of its own, after all others.
        (
            [
                (date(2024, 3, 31), "EUR", "USD", 2.5),
                (gap, "USD", "GRD", 3.25),
                (date(2026, 1, 5), "EUR", "BRL", 4.0),
            ],
            {202403, 202404, 202408, 202601},
        ),
        # A quote that staging drops: the pair leaves its month.
        ([(gap, "USD", "GRD", 0)], {202404, 202408}),
    ]
    for n, (batch, months) in enumerate(steps):
        load_merge(warehouse, quotes(spark, batch), SPEC)
        build_marts(warehouse, SOURCE, AT, changed_only=True, **OPTIONS)
        after = folders(warehouse, "fct_cotizacion")
        changed = {int(p) for p in {*after, *before} if after.get(p) != before.get(p)}
        assert changed == months, n
        before = after
    whole = Warehouse(spark, str(tmp_path / "whole"))
    load_replace(whole, warehouse.read("raw", SPEC.name), SPEC)
    load_replace(whole, raw_catalog(spark), catalog_spec(SOURCE))
    build_marts(whole, SOURCE, AT, **OPTIONS)
    assert marts_of(warehouse) == marts_of(whole)
    build_marts(warehouse, SOURCE, AT, changed_only=True, **OPTIONS)
    assert folders(warehouse, "fct_cotizacion") == before


def test_months_of_a_build_that_failed_are_made_again(spark, warehouse, monkeypatch):
    load_merge(warehouse, quotes(spark, history()), SPEC)
    load_replace(warehouse, raw_catalog(spark), catalog_spec(SOURCE))
    build_marts(warehouse, SOURCE, AT, **OPTIONS)
    load_merge(warehouse, quotes(spark, [(date(2024, 3, 31), "EUR", "USD", 2.5)]), SPEC)
    from tidemart.plans import jobs

    real = jobs.fact_checks
    fails = custom("fails", F.lit(True), severity="error")
    monkeypatch.setattr(jobs, "fact_checks", lambda *a: [fails])
    with pytest.raises(CheckFailed):
        build_marts(warehouse, SOURCE, AT, changed_only=True, **OPTIONS)
    monkeypatch.setattr(jobs, "fact_checks", real)
    build_marts(warehouse, SOURCE, AT, changed_only=True, **OPTIONS)
    march = warehouse.read("marts", "rpt_cotizacion_mensual").filter(
        "anio_mes = '2024-03' AND moneda_cotizada = 'USD'"
    )
    assert march.first().cotizacion_cierre == Decimal("2.5")


def test_another_calendar_remakes_the_months_at_its_edges(spark, warehouse):
    load_merge(warehouse, quotes(spark, history()), SPEC)
    load_replace(warehouse, raw_catalog(spark), catalog_spec(SOURCE))
    short = {**OPTIONS, "calendar_end": date(2025, 3, 10)}
    build_marts(warehouse, SOURCE, AT, **short)
    n = warehouse.read("marts", "fct_cotizacion").count()
    before = folders(warehouse, "fct_cotizacion")
    build_marts(warehouse, SOURCE, AT, changed_only=True, **OPTIONS)
    after = folders(warehouse, "fct_cotizacion")
    assert {int(p) for p in after if after[p] != before.get(p)} >= {202503, 202504, 202508}
    assert before["202412"] == after["202412"]
    assert warehouse.read("marts", "fct_cotizacion").count() == len(history()) > n


def test_raw_table_dealt_otherwise_is_built_whole(spark, warehouse):
    load_replace(warehouse, quotes(spark, history()), SPEC)
    days = (date(1999, 1, 1), date(2028, 1, 1))
    made_of = MadeOf(1, 1, *(d.isoformat() for d in days))
    assert changed_months(warehouse, SPEC, None, *days) is None
    assert changed_months(warehouse, SPEC, made_of, *days) is None


def test_stored_ends_stand_for_earlier_rows(spark):
    df = quotes(spark, history()).select("base", "currency", "date", "rate")
    names = {"rate": "before", "date": "day_before"}
    whole = with_previous(df, ["base", "currency"], "date", names)
    ends = bucket_ends(df, ["base", "currency"], "date", ["rate"], "month")
    part = "date >= '2024-08-01' AND date < '2024-09-01'"
    some = with_previous(df.filter(part), ["base", "currency"], "date", names, "month", ends)
    assert rows(some) == rows(whole.filter(part)) and some.count() > 10
