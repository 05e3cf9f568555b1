"""Names and table declarations shared by loads, checks and jobs."""

from __future__ import annotations

from dataclasses import dataclass

# Layer names, metadata columns and load defaults that must equal the
# reference's (fixed values).
RAW = "raw"
STAGING = "staging"
INTERMEDIATE = "intermediate"
MARTS = "marts"
SCD2 = "scd2"
SEEDS = "seeds"
AUDIT = "dbt_test_audit"
REJECTS = "rejects"
LANDING = "landing"
INGESTED_AT = "_ingested_at"
SOURCE = "_source"
# Where a landed row stands in the order of arrival; orders a batch, is never stored.
ARRIVAL = "_arrival"
HISTORY_START = "1999-01-04"
CALENDAR_START = "1999-01-01"
OVERLAP_DAYS = 7
RECONCILE_OVERLAP_DAYS = 365
WINDOW_MAX_DAYS = 365

# How each layer is materialised: a lazy DataFrame, a temp view or a table.
MATERIALIZATION = {
    RAW: "table",
    STAGING: "view",
    INTERMEDIATE: "inline",
    MARTS: "table",
    SCD2: "table",
    SEEDS: "table",
    AUDIT: "table",
    REJECTS: "table",
    LANDING: "table",
}

DISPOSITIONS = ("replace", "append", "merge")


def raw_table_name(source: str, resource: str) -> str:
    return f"raw_{source}_{resource}"


@dataclass(frozen=True)
class TableSpec:
    """What the loader needs to know about one table.

    ``cursor`` is the business date (or time) that drives incremental loads.
    A merge rewrites only the touched partitions, so the partition has to be a
    function of the key: the month of the cursor when the cursor belongs to the
    key, else one of ``buckets`` hash buckets of the key. ``required`` names columns
    besides keys and cursor that must not be null. ``disposition`` says how a batch
    enters the table: ``replace``, ``append`` or ``merge``.
    """

    name: str
    keys: tuple[str, ...]
    cursor: str | None = None
    layer: str = RAW
    order_by: tuple[str, ...] = ()
    buckets: int = 64
    required: tuple[str, ...] = ()
    disposition: str = "merge"

    def __post_init__(self) -> None:
        if self.disposition not in DISPOSITIONS:
            raise ValueError(f"{self.name}: unknown disposition {self.disposition!r}")

    @property
    def not_null(self) -> tuple[str, ...]:
        """Columns without which a row can't enter: keys, cursor and required ones."""
        cursor = (self.cursor,) if self.cursor else ()
        return tuple(dict.fromkeys([*self.keys, *cursor, *self.required]))

    @property
    def by_month(self) -> bool:
        return self.cursor is not None and self.cursor in self.keys


def rates_spec(source: str) -> TableSpec:
    return TableSpec(
        name=raw_table_name(source, "exchange_rates"),
        keys=("date", "base", "currency"),
        cursor="date",
        order_by=(INGESTED_AT,),
        required=("rate",),
    )


def catalog_spec(source: str) -> TableSpec:
    return TableSpec(
        name=raw_table_name(source, "currencies"),
        keys=("code",),
        required=("name",),
        disposition="replace",
    )


def declared_tables(source: str) -> tuple[TableSpec, ...]:
    """Every raw table of a source, with its keys, cursor and disposition."""
    return (rates_spec(source), catalog_spec(source))
