from tidemart.loads.dispositions import (
    audit_rows,
    evolve,
    load_append,
    load_merge,
    load_replace,
    load_snapshot,
    load_summary,
    materialize,
    month_of,
    replace_months,
    store_failures,
    write_replace,
)
from tidemart.loads.incremental import LoadWindow, filter_window, load_incremental, next_start, plan_load
from tidemart.loads.intake import Intake, load_intake, reject_reason, take_in
from tidemart.loads.manifest import files_due, landing_manifest, list_landing, paths_due, record_files
from tidemart.loads.warehouse import TableState, Warehouse

__all__ = [
    "Intake",
    "LoadWindow",
    "TableState",
    "Warehouse",
    "audit_rows",
    "evolve",
    "files_due",
    "filter_window",
    "list_landing",
    "load_append",
    "load_incremental",
    "load_intake",
    "load_merge",
    "load_replace",
    "load_snapshot",
    "load_summary",
    "landing_manifest",
    "materialize",
    "month_of",
    "next_start",
    "paths_due",
    "plan_load",
    "record_files",
    "reject_reason",
    "replace_months",
    "store_failures",
    "take_in",
    "write_replace",
]
