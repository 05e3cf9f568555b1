"""Small inputs with known answers (see FIXTURES.md)."""

from datetime import date, datetime
from decimal import Decimal

LOADED = datetime(2026, 1, 7, 12, 0)
SOURCE = "fx"
BASE = "EUR"

RATES = [
    ("2026-01-02", "USD", "1.1721"),
    ("2026-01-02", "BRL", "6.3743"),
    ("2026-01-02", "GRD", "340.75"),
    ("2026-01-05", "USD", "1.1664"),
    ("2026-01-05", "BRL", "6.3470"),
    ("2026-01-05", "GRD", "340.75"),
    ("2026-01-06", "USD", "1.1707"),
    ("2026-01-06", "BRL", "6.3201"),
    ("2026-01-06", "IDR", "20677.34"),
]
CATALOG = [
    ("USD", "United States Dollar"),
    ("BRL", "Brazilian Real"),
    ("IDR", "Indonesian Rupiah"),
]
RAW_RATES = (
    "date DATE, base STRING, currency STRING, rate DECIMAL(20,8), amount DECIMAL(20,8), "
    "_ingested_at TIMESTAMP, _source STRING"
)


def raw_rates(spark):
    rows = [
        (date.fromisoformat(d), BASE, c, Decimal(r), Decimal(1), LOADED, SOURCE) for d, c, r in RATES
    ]
    return spark.createDataFrame(rows, RAW_RATES)


def raw_catalog(spark):
    rows = [(code, name, LOADED, SOURCE) for code, name in CATALOG]
    return spark.createDataFrame(
        rows, "code STRING, name STRING, _ingested_at TIMESTAMP, _source STRING"
    )


def rows(df, *columns):
    """The rows as a sorted list of tuples."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=repr)
