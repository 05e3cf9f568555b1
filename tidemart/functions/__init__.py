from tidemart.functions.clock import (
    CALENDAR_COLUMNS,
    calendar_columns,
    instant_to_local,
    moment,
    utc_to_local,
)
from tidemart.functions.keys import row_id, surrogate_key, timestamp_key
from tidemart.functions.measures import (
    days_between,
    guarded_pct_change,
    pct_change,
    reciprocal,
    reciprocal_error,
)
from tidemart.functions.text import blank_to_null, clean_code, iso_date

__all__ = [
    "CALENDAR_COLUMNS",
    "blank_to_null",
    "calendar_columns",
    "clean_code",
    "days_between",
    "guarded_pct_change",
    "instant_to_local",
    "iso_date",
    "moment",
    "pct_change",
    "reciprocal",
    "reciprocal_error",
    "row_id",
    "surrogate_key",
    "timestamp_key",
    "utc_to_local",
]
