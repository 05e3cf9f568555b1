from tidemart.plans.jobs import (
    build_marts,
    diagnose,
    load_catalog,
    load_rates,
    missing_weekdays,
    reconcile_rates,
    source_freshness,
    staging_views,
)
from tidemart.plans.marts import (
    currency_activity,
    daily_quotes,
    dim_currency,
    dim_currency_history,
    dim_date,
    fact_quotes,
    monthly_report,
)
from tidemart.plans.staging import stage_catalog, stage_quotes

__all__ = [
    "build_marts",
    "currency_activity",
    "daily_quotes",
    "dim_currency",
    "dim_currency_history",
    "diagnose",
    "dim_date",
    "fact_quotes",
    "load_catalog",
    "load_rates",
    "missing_weekdays",
    "monthly_report",
    "reconcile_rates",
    "source_freshness",
    "stage_catalog",
    "stage_quotes",
    "staging_views",
]
