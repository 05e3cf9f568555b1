from tidemart.sources.calendar import calendar, default_calendar_end
from tidemart.sources.payloads import (
    FILE_COLUMNS,
    PAYLOAD_SCHEMA,
    arrival,
    flatten_payloads,
    normalize_payloads,
    parse_replies,
    read_catalog_payload,
    read_quote_payloads,
    select_symbols,
    with_file,
)
from tidemart.sources.landing import landed_files
from tidemart.sources.seeds import currency_region_seed, read_seed
from tidemart.sources.stamp import with_metadata, with_row_id

__all__ = [
    "FILE_COLUMNS",
    "PAYLOAD_SCHEMA",
    "arrival",
    "calendar",
    "currency_region_seed",
    "default_calendar_end",
    "flatten_payloads",
    "landed_files",
    "normalize_payloads",
    "parse_replies",
    "read_catalog_payload",
    "read_quote_payloads",
    "read_seed",
    "select_symbols",
    "with_file",
    "with_metadata",
    "with_row_id",
]
