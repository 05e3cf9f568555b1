from datetime import date, datetime
from decimal import Decimal as D

import pytest
from data import rows

from tidemart.loads import load_merge, load_replace
from tidemart.sources import (
    currency_region_seed,
    read_catalog_payload,
    read_quote_payloads,
    read_seed,
    select_symbols,
    with_metadata,
    with_row_id,
)
from tidemart.specs import catalog_spec, rates_spec, raw_table_name

RANGE = (
    '{"amount":1.0,"base":"EUR","rates":{"2026-01-02":{"USD":1.17,"BRL":6.37},'
    '"2026-01-05":{"USD":1.16,"BRL":6.34}}}'
)
ONE_DAY = '{"amount":1.0,"base":"EUR","date":"2026-01-02","rates":{"USD":1.17}}'


def land(tmp_path, *lines):
    path = tmp_path / "payload.json"
    path.write_text("\n".join(lines))
    return str(path)


def read(spark, tmp_path, *lines):
    return read_quote_payloads(spark, land(tmp_path, *lines), "EUR")


def test_range_reply_becomes_typed_long_rows(spark, tmp_path):
    df = read(spark, tmp_path, RANGE)
    assert dict(df.dtypes) == {
        "date": "date",
        "base": "string",
        "currency": "string",
        "rate": "decimal(20,8)",
        "amount": "decimal(20,8)",
    }
    assert rows(df, "date", "base", "currency", "rate") == [
        (date(2026, 1, 2), "EUR", "BRL", D("6.37000000")),
        (date(2026, 1, 2), "EUR", "USD", D("1.17000000")),
        (date(2026, 1, 5), "EUR", "BRL", D("6.34000000")),
        (date(2026, 1, 5), "EUR", "USD", D("1.16000000")),
    ]


def test_one_day_reply_is_nested_by_its_date(spark, tmp_path):
    assert rows(read(spark, tmp_path, ONE_DAY), "date", "rate") == [(date(2026, 1, 2), D("1.17"))]


def test_one_day_reply_without_date_takes_the_requested_start(spark, tmp_path):
    reply = '{"requested_from":"2026-01-03","rates":{"USD":1.17}}'
    got = rows(read(spark, tmp_path, reply), "date", "amount")
    assert got == [(date(2026, 1, 3), D(1))]


@pytest.mark.parametrize("reply", ["{}", '{"amount":1.0,"rates":{}}', '{"base":"EUR"}'])
def test_no_data_is_no_rows(spark, tmp_path, reply):
    assert read(spark, tmp_path, reply).count() == 0
    assert read(spark, tmp_path, reply, RANGE).count() == 4


def test_base_is_the_runs_own(spark, tmp_path):
    df = read_quote_payloads(spark, land(tmp_path, RANGE), "XXX")
    assert rows(df.select("base").distinct()) == [("XXX",)]


def test_large_values_keep_their_digits(spark, tmp_path):
    reply = '{"date":"2001-02-22","rates":{"TRL":1900000.12345678,"BIG":123456789012.12345678}}'
    assert rows(read(spark, tmp_path, reply), "currency", "rate") == [
        ("BIG", D("123456789012.12345678")),
        ("TRL", D("1900000.12345678")),
    ]


def test_malformed_reply_fails(spark, tmp_path):
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read(spark, tmp_path, '{"rates":{').count()


def test_shape_is_told_by_the_first_value(spark, tmp_path):
    odd_key = '{"date":"2026-01-02","rates": { "a\\"}:{" : 1.5 } }'
    spaced = '{"rates": { "2026-01-03" : {"X" : 2.5 , "Y": null} , "2026-01-04" : {} } }'
    assert rows(read(spark, tmp_path, odd_key, spaced), "date", "currency", "rate") == [
        (date(2026, 1, 2), 'a"}:{', D("1.5")),
        (date(2026, 1, 3), "X", D("2.5")),
        (date(2026, 1, 3), "Y", None),
    ]


@pytest.mark.parametrize("rates", ["[1]", '"n/a"', '{"2026-01-02":{"USD":"x"}}'])
def test_rates_of_another_shape_fail(spark, tmp_path, rates):
    with pytest.raises(Exception, match="unknown shape"):
        read(spark, tmp_path, '{"date":"2026-01-02","rates":%s}' % rates).count()


def test_symbols(spark, tmp_path):
    df = read(spark, tmp_path, RANGE)
    assert select_symbols(df, ["USD"]).count() == 2
    assert select_symbols(df, []).count() == 4


def test_landed_rates_are_merged_with_provenance(spark, warehouse, tmp_path):
    spec = rates_spec("fx")
    assert spec.name == raw_table_name("fx", "exchange_rates") == "raw_fx_exchange_rates"
    batch = with_metadata(read(spark, tmp_path, RANGE), f"fx.{spec.name}")
    for _ in range(2):
        load_merge(warehouse, batch, spec)
    raw = warehouse.read("raw", spec.name)
    assert raw.count() == 4
    assert raw.filter("_ingested_at IS NULL OR _source <> 'fx.raw_fx_exchange_rates'").isEmpty()
    corrected = RANGE.replace('"2026-01-02":{"USD":1.17', '"2026-01-02":{"USD":9.99')
    load_merge(warehouse, with_metadata(read(spark, tmp_path, corrected), "fx.again"), spec)
    raw = warehouse.read("raw", spec.name)
    assert raw.count() == 4
    assert rows(raw.filter("currency = 'USD' AND date = '2026-01-02'"), "rate") == [(D("9.99"),)]


def test_catalog_is_replaced(spark, warehouse, tmp_path):
    path = land(tmp_path, '{"USD":"United States Dollar","BRL":"Brazilian Real"}')
    for _ in range(2):
        load_replace(warehouse, read_catalog_payload(spark, path), catalog_spec("fx"))
    assert rows(warehouse.read("raw", "raw_fx_currencies")) == [
        ("BRL", "Brazilian Real"),
        ("USD", "United States Dollar"),
    ]
    assert warehouse.unused_folders("raw", "raw_fx_currencies").count() == 1


def test_metadata_leaves_business_columns_alone(spark):
    df = spark.createDataFrame([(1, "a")], "id INT, `Fecha Emisión` STRING")
    stamped = with_metadata(df, "s.t", datetime(2026, 1, 1, 3, 0))
    assert stamped.columns == ["id", "Fecha Emisión", "_ingested_at", "_source"]
    assert rows(stamped) == [(1, "a", datetime(2026, 1, 1, 3, 0), "s.t")]
    assert not with_metadata(df, "s.t").schema["_ingested_at"].nullable


def test_row_id_is_stable_and_counts_missing_as_empty(spark):
    import hashlib

    df = spark.createDataFrame([("x", None), ("x", "1")], "a STRING, b STRING")
    got = {r.b: r._row_id for r in with_row_id(df, ["a", "b"]).collect()}
    assert got[None] == hashlib.sha256(b"x|").hexdigest()
    assert got["1"] == hashlib.sha256(b"x|1").hexdigest()


def test_seed_keeps_leading_zeros(spark, tmp_path):
    path = tmp_path / "seed.csv"
    path.write_text("code,name\n007,Bond\n")
    assert rows(read_seed(spark, str(path), "code STRING, name STRING")) == [("007", "Bond")]


def test_builtin_seed(spark):
    seed = currency_region_seed(spark)
    assert seed.count() == 47
    assert rows(seed.filter("codigo_moneda = 'GRD'")) == [("GRD", "Dracma Griego", "Europa")]


def test_replies_are_parsed_once_and_not_by_the_json_reader(spark, tmp_path):
    df = read(spark, tmp_path, RANGE, ONE_DAY, '{"base":"EUR","rates":{}}', '{"base":"EUR"}')
    assert df.count() == 5
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") + plan.count("parse_json") == 1


@pytest.mark.parametrize(
    "line, found",
    [
        ("[" + ONE_DAY + "," + ONE_DAY + "]", 2),
        (ONE_DAY.replace('"', "'"), 1),
        ('{"date":"2026-01-02","rates":{"USD":1.17,"USD":1.18}}', 2),
        ('{"date":"2026-01-02","rates":{"USD":null,"BRL":"6.37"}}', 2),
        ('{"date":"2026-01-02","rates":{"USD":1.17E-5}}', 1),
        ('{"fetched_at":"2026-01-07T12:00:00Z","rates":{"2026-01-02":{"USD":1},"2026-01-05":null}}', 1),
        ("  ", 0),
    ],
)
def test_lines_of_other_forms(spark, tmp_path, line, found):
    assert len(read(spark, tmp_path, line).collect()) == found
