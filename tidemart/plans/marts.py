"""The exchange-rate star schema.

No join here carries a broadcast hint, unless asked to leave quotes in place: Spark
broadcasts a dimension when its measured size allows it, and otherwise shuffles,
splitting skewed partitions at run time.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions import (
    calendar_columns,
    days_between,
    instant_to_local,
    pct_change,
    reciprocal,
    surrogate_key,
    timestamp_key,
)
from tidemart.operators import (
    activity_by_period,
    bucket_ends,
    entity_activity,
    period_summary,
    with_previous,
)
from tidemart.operators.buckets import BUCKET
from tidemart.operators.scd2 import VALID_FROM, VALID_TO
from tidemart.operators.series import SHARE, dealt_by
from tidemart.session import DISPLAY_TIMEZONE, session_date
from tidemart.sources import calendar, default_calendar_end
from tidemart.specs import CALENDAR_START

PAIR = ("moneda_base", "moneda_cotizada")
UNCLASSIFIED = "Sin clasificar"  # region of an entity the seed does not list (fixed value)


def month_closes(quotes: DataFrame) -> DataFrame:
    """Last quote of each pair and month, which the pair's next month begins with."""
    ends = bucket_ends(quotes, PAIR, "fecha", ["cotizacion"], "month")
    return ends.withColumnRenamed(BUCKET, "mes")


def daily_quotes(
    quotes: DataFrame, closes: DataFrame | None = None, shares: int | None = None
) -> DataFrame:
    """Quotes with the measures that need the pair's previous published day.

    With the `month_closes` of the whole history, ``quotes`` may be those of some months.
    ``shares`` deals them out by month and that many shares of the pairs.
    """
    value, previous = F.col("cotizacion"), F.col("cotizacion_anterior")
    return with_previous(
        quotes,
        PAIR,
        "fecha",
        {"cotizacion": "cotizacion_anterior", "fecha": "fecha_anterior"},
        period=None if closes is None else "month",
        ends=None if closes is None else closes.withColumnRenamed("mes", BUCKET),
        shares=shares,
    ).select(
        "fecha",
        *PAIR,
        "cotizacion",
        "cotizacion_anterior",
        "fecha_anterior",
        days_between(F.col("fecha"), F.col("fecha_anterior")).alias("dias_desde_anterior"),
        reciprocal(value).alias("cotizacion_inversa"),
        pct_change(value, previous).alias("variacion_pct"),
        "cargado_en",
        "origen_dato",
    )


def monthly_activity(quotes: DataFrame) -> DataFrame:
    """Activity per currency and month, as `currency_activity` adds it up."""
    return activity_by_period(
        quotes, "moneda_cotizada", "moneda_base", "fecha", "codigo_moneda", "month"
    ).withColumnRenamed("period", "mes")


def currency_activity(
    quotes: DataFrame | None, catalog: DataFrame, months: DataFrame | None = None
) -> DataFrame:
    """Every currency of the history, with its span of activity.

    ``months``, the `monthly_activity` of the whole history, stands for the quotes.
    """
    return entity_activity(
        quotes,
        catalog,
        entity="moneda_cotizada",
        base="moneda_base",
        at="fecha",
        code="codigo_moneda",
        name="nombre_moneda",
        names={
            "first_at": "primera_fecha",
            "last_at": "ultima_fecha",
            "n_at": "cantidad_dias_cotizados",
            "is_listed": "es_vigente",
            "is_base": "es_moneda_base",
        },
        periods=months,
    )


def dim_date(
    spark: SparkSession,
    start: date = date.fromisoformat(CALENDAR_START),
    end: date | None = None,
    language: str = "en",
) -> DataFrame:
    """One row per day, days without facts included; ``end`` is not covered."""
    days = calendar(spark, start, end or default_calendar_end(session_date(spark)))
    return days.select(*calendar_columns(F.col("fecha"), language))


def dim_currency(activity: DataFrame, seed: DataFrame) -> DataFrame:
    """Currencies as they are today, retired ones included."""
    return activity.join(seed, "codigo_moneda", "left").select(
        surrogate_key(F.col("codigo_moneda")).alias("clave_moneda"),
        "codigo_moneda",
        F.coalesce("nombre_moneda", "nombre_alternativo", "codigo_moneda").alias("nombre_moneda"),
        F.coalesce("region", F.lit(UNCLASSIFIED)).alias("region"),
        "es_vigente",
        "es_moneda_base",
        "primera_fecha",
        "ultima_fecha",
        "cantidad_dias_cotizados",
    )


def dim_currency_history(history: DataFrame, zone: str = DISPLAY_TIMEZONE) -> DataFrame:
    """Versions of the catalog in local time, with a key per version."""
    code = F.col("codigo_moneda")
    utc_start = timestamp_key(instant_to_local(F.col(VALID_FROM), "UTC"))
    return history.select(
        surrogate_key(code, utc_start).alias("clave_version"),
        surrogate_key(code).alias("clave_moneda"),
        "codigo_moneda",
        "nombre_moneda",
        instant_to_local(F.col(VALID_FROM), zone).alias("valido_desde"),
        instant_to_local(F.col(VALID_TO), zone).alias("valido_hasta"),
        F.col(VALID_TO).isNull().alias("es_version_vigente"),
    )


def fact_quotes(
    daily: DataFrame, dates: DataFrame, currencies: DataFrame, in_place: bool = False
) -> DataFrame:
    """Periodic snapshot, one row per date and pair, keyed to its dimensions.

    The currency dimension plays two roles. Quotes outside a dimension drop out;
    `relationships` and `find_gaps` show whether any did. ``in_place`` leaves quotes in the
    tasks they are in; dimensions are then sent to all, and have to be small enough.
    """

    def sent(dimension: DataFrame) -> DataFrame:
        return F.broadcast(dimension) if in_place else dimension

    days = sent(dates.select("fecha", "clave_fecha"))

    def role(code: str, key: str) -> DataFrame:
        columns = F.col("codigo_moneda").alias(code), F.col("clave_moneda").alias(key)
        return sent(currencies.select(*columns))

    return (
        daily.join(days, "fecha")
        .join(role("moneda_base", "clave_moneda_base"), "moneda_base")
        .join(role("moneda_cotizada", "clave_moneda_cotizada"), "moneda_cotizada")
        .select(
            "clave_fecha",
            "clave_moneda_base",
            "clave_moneda_cotizada",
            "fecha",
            *PAIR,
            "cotizacion",
            "cotizacion_inversa",
            "cotizacion_anterior",
            "variacion_pct",
            "dias_desde_anterior",
            "cargado_en",
            "origen_dato",
        )
    )


def monthly_report(fact: DataFrame, dates: DataFrame, shares: int | None = None) -> DataFrame:
    """Count, average, range, open, close and volatility per month and pair.

    ``shares`` deals quotes out by month and that many shares of the pairs, so that what
    is written by month needs no other shuffle. A pair has one quote a day.
    """
    months = dates.select("clave_fecha", "anio_mes", "anio", "mes")
    quotes, keys = fact.join(months, "clave_fecha"), ["anio_mes", "anio", "mes", *PAIR]
    if shares is not None:
        used = [*keys, "fecha", "cotizacion", "variacion_pct"]
        quotes, keys = dealt_by(quotes.select(*used), "anio_mes", PAIR, shares), [*keys, SHARE]
    return period_summary(
        quotes,
        keys=keys,
        at="fecha",
        value="cotizacion",
        change="variacion_pct",
        names={
            "n": "cantidad_dias_publicados",
            "average": "cotizacion_promedio",
            "minimum": "cotizacion_minima",
            "maximum": "cotizacion_maxima",
            "first": "cotizacion_apertura",
            "last": "cotizacion_cierre",
            "deviation": "volatilidad_pct",
            "change": "variacion_mensual_pct",
        },
    ).drop(SHARE)
