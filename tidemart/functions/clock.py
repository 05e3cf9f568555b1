"""Time zones and calendar attributes."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

# Month and weekday names (Monday first) per language (fixed values).
MONTH_NAMES = {
    "en": (
        "January", "February", "March", "April", "May", "June",
        "July", "August", "September", "October", "November", "December",
    ),
    "es": (
        "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
        "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
    ),
}
DAY_NAMES = {
    "en": ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"),
    "es": ("Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado", "Domingo"),
}

# Column names of the date dimension, in the reference's order (fixed values).
CALENDAR_COLUMNS = (
    "clave_fecha",
    "fecha",
    "anio",
    "trimestre",
    "mes",
    "dia_del_mes",
    "dia_de_semana",
    "semana_iso",
    "nombre_mes",
    "nombre_dia",
    "anio_mes",
    "nombre_trimestre",
    "es_dia_habil",
    "es_primer_dia_del_mes",
    "es_ultimo_dia_del_mes",
    "primer_dia_del_mes",
    "ultimo_dia_del_mes",
)


def moment(ts: datetime, data_type: str | DataType = "timestamp") -> Column:
    """A literal; a time without a zone is read in the session's, not the driver's."""
    return F.lit(ts.isoformat(" ")).cast(data_type)


def utc_to_local(ts: Column, zone: str | Column) -> Column:
    """UTC wall time (``TIMESTAMP_NTZ``) to wall time in ``zone``."""
    return F.convert_timezone(F.lit("UTC"), zone if isinstance(zone, Column) else F.lit(zone), ts)


def instant_to_local(ts: Column, zone: str | Column) -> Column:
    """Instant (``TIMESTAMP``) to wall time in ``zone``, whatever the session zone is."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return utc_to_local(F.timestamp_add("MICROSECOND", F.unix_micros(ts), epoch), zone)


def _name(names: tuple[str, ...], position: Column) -> Column:
    return F.element_at(F.array(*(F.lit(n) for n in names)), position)


def calendar_columns(day: Column, language: str = "en") -> list[Column]:
    """The 17 attributes of one calendar day, aliased as ``CALENDAR_COLUMNS``."""
    weekday = F.weekday(day) + 1
    first, last = F.trunc(day, "MONTH"), F.last_day(day)
    values = (
        F.date_format(day, "yyyyMMdd").cast("int"),
        day,
        F.year(day),
        F.quarter(day),
        F.month(day),
        F.dayofmonth(day),
        weekday,
        F.weekofyear(day),
        _name(MONTH_NAMES[language], F.month(day)),
        _name(DAY_NAMES[language], weekday),
        F.date_format(day, "yyyy-MM"),
        F.concat(F.lit("T"), F.quarter(day).cast("string")),
        weekday.between(1, 5),
        day == first,
        day == last,
        first,
        last,
    )
    return [value.alias(name) for value, name in zip(values, CALENDAR_COLUMNS, strict=True)]
