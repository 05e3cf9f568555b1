from tidemart.operators.activity import activity_by_period, entity_activity
from tidemart.operators.checks import (
    Check,
    between,
    custom,
    length_equals,
    no_future,
    not_null,
    reciprocal_coherence,
    relationships,
    session_timezone,
    unique,
    unique_combination,
)
from tidemart.operators.dedup import latest_by_key
from tidemart.operators.gate import CheckFailed, check_results, enforce, overall_status
from tidemart.operators.history import asof_lookup, valid_at
from tidemart.operators.profile import freshness, raw_profile
from tidemart.operators.scd2 import apply_snapshot, step_snapshot
from tidemart.operators.series import bucket_ends, period_summary, with_previous
from tidemart.operators.windows import find_gaps, plan_windows

__all__ = [
    "Check",
    "CheckFailed",
    "activity_by_period",
    "apply_snapshot",
    "asof_lookup",
    "between",
    "bucket_ends",
    "check_results",
    "custom",
    "enforce",
    "entity_activity",
    "find_gaps",
    "freshness",
    "latest_by_key",
    "length_equals",
    "no_future",
    "not_null",
    "overall_status",
    "period_summary",
    "plan_windows",
    "raw_profile",
    "reciprocal_coherence",
    "relationships",
    "session_timezone",
    "step_snapshot",
    "unique",
    "unique_combination",
    "valid_at",
    "with_previous",
]
