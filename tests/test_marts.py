"""The star schema on the nine-row history."""

from datetime import date, datetime
from decimal import Decimal as D

import pytest
from data import CATALOG, SOURCE, raw_catalog, raw_rates, rows
from pyspark.sql import functions as F

from tidemart.loads import audit_rows, load_merge, load_replace
from tidemart.operators import CheckFailed
from tidemart.plans import (
    build_marts,
    currency_activity,
    daily_quotes,
    dim_currency,
    diagnose,
    dim_date,
    fact_quotes,
    load_rates,
    missing_weekdays,
    monthly_report,
    reconcile_rates,
    source_freshness,
    stage_catalog,
    stage_quotes,
)
from tidemart.sources import currency_region_seed
from tidemart.specs import catalog_spec, rates_spec

SNAPSHOT = datetime(2026, 1, 7, 12, 0)


@pytest.fixture(scope="module")
def star(spark):
    quotes, catalog = stage_quotes(raw_rates(spark)), stage_catalog(raw_catalog(spark))
    dates = dim_date(spark, end=date(2028, 1, 1))
    currencies = dim_currency(currency_activity(quotes, catalog), currency_region_seed(spark))
    fact = fact_quotes(daily_quotes(quotes), dates, currencies)
    return dates, currencies, fact


def test_previous_publication(spark):
    daily = daily_quotes(stage_quotes(raw_rates(spark)))
    got = {
        (r.moneda_cotizada, str(r.fecha)): (
            r.cotizacion_anterior,
            r.dias_desde_anterior,
            str(r.cotizacion_inversa),
            r.variacion_pct,
        )
        for r in daily.collect()
    }
    assert len(got) == 9
    assert got["BRL", "2026-01-02"] == (None, None, "0.156879971134085311328", None)
    assert got["BRL", "2026-01-05"] == (D("6.3743"), 3, "0.157554750275720812983", D("-0.428282"))
    assert got["BRL", "2026-01-06"] == (D("6.3470"), 1, "0.158225344535687726460", D("-0.423822"))
    assert got["GRD", "2026-01-05"] == (D("340.75"), 3, "0.002934702861335289802", D("0"))
    assert got["IDR", "2026-01-06"] == (None, None, "0.000048362120079275187", None)
    assert got["USD", "2026-01-05"] == (D("1.1721"), 3, "0.857338820301783264746", D("-0.486307"))
    assert got["USD", "2026-01-06"] == (D("1.1664"), 1, "0.854189800973776373110", D("0.368656"))


def test_currency_dimension(star):
    _, currencies, _ = star
    got = rows(currencies.drop("clave_moneda"))
    first, second, third = date(2026, 1, 2), date(2026, 1, 5), date(2026, 1, 6)
    assert got == [
        ("BRL", "Brazilian Real", "América", True, False, first, third, 3),
        ("EUR", "Euro", "Europa", False, True, None, None, 0),
        ("GRD", "Dracma Griego", "Europa", False, False, first, second, 2),
        ("IDR", "Indonesian Rupiah", "Asia", True, False, third, third, 1),
        ("USD", "United States Dollar", "América", True, False, first, third, 3),
    ]


def test_fact_has_every_quote_and_its_keys(star):
    _, currencies, fact = star
    assert fact.count() == 9
    keys = {r.codigo_moneda: r.clave_moneda for r in currencies.collect()}
    for r in fact.collect():
        assert r.clave_fecha == int(r.fecha.strftime("%Y%m%d"))
        assert r.clave_moneda_base == keys["EUR"]
        assert r.clave_moneda_cotizada == keys[r.moneda_cotizada]


def test_monthly_report(star):
    dates, _, fact = star
    got = {r.moneda_cotizada: r for r in monthly_report(fact, dates).collect()}
    assert {r.anio_mes for r in got.values()} == {"2026-01"}
    brl = got["BRL"]
    assert brl.cantidad_dias_publicados == 3
    assert brl.cotizacion_promedio == D("6.34713333")
    assert (brl.cotizacion_minima, brl.cotizacion_maxima) == (D("6.3201"), D("6.3743"))
    assert (brl.cotizacion_apertura, brl.cotizacion_cierre) == (D("6.3743"), D("6.3201"))
    assert (brl.volatilidad_pct, brl.variacion_mensual_pct) == (0.003154, D("-0.850289"))
    assert (got["USD"].volatilidad_pct, got["USD"].variacion_mensual_pct) == (0.60455, D("-0.119444"))
    assert (got["IDR"].volatilidad_pct, got["IDR"].variacion_mensual_pct) == (0, D(0))


def test_date_dimension(spark):
    days = dim_date(spark, date(2026, 1, 1), date(2026, 2, 1))
    got = {r.fecha: r for r in days.collect()}
    assert len(got) == 31
    thursday = got[date(2026, 1, 1)]
    assert tuple(thursday) == (
        20260101, date(2026, 1, 1), 2026, 1, 1, 1, 4, 1, "January", "Thursday", "2026-01", "T1",
        True, True, False, date(2026, 1, 1), date(2026, 1, 31),
    )
    assert got[date(2026, 1, 31)].es_ultimo_dia_del_mes
    assert not got[date(2026, 1, 31)].es_dia_habil
    spanish = dim_date(spark, date(2026, 1, 1), date(2026, 1, 2), language="es").first()
    assert (spanish.nombre_mes, spanish.nombre_dia) == ("Enero", "Jueves")


def test_staging_drops_impossible_rates_and_cleans_codes(spark):
    raw = spark.sql(
        "SELECT DATE'2026-01-02' date, ' eur ' base, 'usd' currency, CAST(r AS DECIMAL(20,8)) rate,"
        " CAST(1 AS DECIMAL(20,8)) amount, TIMESTAMP'2026-01-02 10:00:00' _ingested_at, 's' _source"
        " FROM VALUES (1.5), (0), (-1), (NULL) AS t(r)"
    )
    assert rows(stage_quotes(raw), "moneda_base", "moneda_cotizada", "cotizacion") == [
        ("EUR", "USD", D("1.5"))
    ]
    catalog = spark.sql(
        "SELECT ' hrk' code, '  ' name, TIMESTAMP'2026-01-02 10:00:00' _ingested_at, 's' _source"
    )
    assert rows(stage_catalog(catalog), "codigo_moneda", "nombre_moneda") == [("HRK", None)]


def load_raw(spark, warehouse, catalog=None):
    load_merge(warehouse, raw_rates(spark), rates_spec(SOURCE))
    load_replace(warehouse, catalog or raw_catalog(spark), catalog_spec(SOURCE))


def test_build_writes_marts_and_is_repeatable(spark, warehouse):
    load_raw(spark, warehouse)
    options = dict(today=date(2026, 1, 7), calendar_end=date(2028, 1, 1))
    for _ in range(2):
        marts = build_marts(warehouse, SOURCE, SNAPSHOT, **options)
        assert {name: df.count() for name, df in marts.items()} == {
            "dim_fecha": 10592,
            "dim_moneda": 5,
            "dim_moneda_historia": len(CATALOG),
            "fct_cotizacion": 9,
            "rpt_cotizacion_mensual": 4,
        }
    version = marts["dim_moneda_historia"].first()
    assert str(version.valido_desde) == "2026-01-07 09:00:00"  # 12:00 UTC in Buenos Aires
    assert version.es_version_vigente and version.valido_hasta is None
    assert spark.table(f"stg_{SOURCE}__monedas").count() == 3


def test_job_reports(spark, warehouse, tmp_path):
    assert {r.n_problems for r in diagnose(warehouse, SOURCE).collect()} == {1}  # nothing there yet
    landing = tmp_path / "rates.json"
    landing.write_text('{"date":"2026-01-02","rates":{"USD":1.17}}')
    assert load_rates(warehouse, SOURCE, str(landing), "EUR", SNAPSHOT).refresh
    assert reconcile_rates(warehouse, SOURCE, str(landing), "EUR", SNAPSHOT).start == date(2025, 1, 2)
    found = {r.table: r for r in diagnose(warehouse, SOURCE).collect()}
    rates = found[f"raw_{SOURCE}_exchange_rates"]
    assert (rates.n_rows, rates.cursor_max, rates.n_problems) == (1, "2026-01-02", 0)
    assert source_freshness(warehouse, SOURCE, datetime(2026, 1, 9)).first().status == "warn"


def test_missing_weekdays(spark, warehouse):
    load_merge(warehouse, raw_rates(spark), rates_spec(SOURCE))
    gaps = missing_weekdays(warehouse, SOURCE, date(2025, 12, 31), date(2026, 1, 9))
    assert rows(gaps) == [
        ("EUR", date(2025, 12, 31), date(2026, 1, 1), 2),
        ("EUR", date(2026, 1, 7), date(2026, 1, 8), 2),
    ]


def test_quotes_a_dimension_lacks_are_reported(spark, warehouse):
    load_raw(spark, warehouse)
    build_marts(warehouse, SOURCE, SNAPSHOT, today=date(2026, 1, 7), calendar_end=date(2026, 1, 6))
    found = audit_rows(warehouse)
    dropped = found.filter("table = 'stg_cotizaciones' AND check = 'relationships_fecha'")
    assert rows(dropped, "row") == [('{"fecha":"2026-01-06","n_records":3}',)]
    # The session runs in UTC, the project doesn't; one run of the marts is one run here.
    assert rows(found, "table", "check") == [
        ("session", "session_timezone"),
        ("stg_cotizaciones", "relationships_fecha"),
    ]
    assert found.select("run").distinct().count() == 1
    assert warehouse.read("marts", "fct_cotizacion").count() == 6


def test_failing_error_check_stops_the_marts_and_keeps_the_rows(spark, warehouse):
    nameless = raw_catalog(spark).selectExpr("code", "' ' AS name", "_ingested_at", "_source")
    load_raw(spark, warehouse, nameless)
    with pytest.raises(CheckFailed, match="not_null_nombre_moneda"):
        build_marts(warehouse, SOURCE, SNAPSHOT)
    found = audit_rows(warehouse).filter("check = 'not_null_nombre_moneda'")
    assert found.count() == 3
    assert not warehouse.exists("marts", "fct_cotizacion")


def test_raw_tables_are_checked_before_staging_hides_what_is_wrong(spark, warehouse):
    bad = raw_rates(spark).withColumn("rate", F.when(F.col("currency") != "GRD", F.col("rate")))
    load_replace(warehouse, bad.unionByName(bad.limit(1)), rates_spec(SOURCE))
    load_replace(warehouse, raw_catalog(spark), catalog_spec(SOURCE))
    with pytest.raises(CheckFailed, match="unique_combination_date_base_currency"):
        build_marts(warehouse, SOURCE, SNAPSHOT)
    found = audit_rows(warehouse).filter(F.col("table") == rates_spec(SOURCE).name)
    assert rows(found.groupBy("check").count()) == [
        ("not_null_rate", 2),
        ("unique_combination_date_base_currency", 1),
    ]
    assert not warehouse.exists("seeds", "seed_moneda_region")


def test_session_of_the_projects_zone_finds_nothing(spark, warehouse):
    load_raw(spark, warehouse)
    build_marts(warehouse, SOURCE, SNAPSHOT, today=date(2026, 1, 7), zone="UTC")
    assert audit_rows(warehouse).count() == 0
