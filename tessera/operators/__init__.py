"""DataFrame operators of the warehouse."""

from tessera.operators.bronze import extract_bronze, select_columns
from tessera.operators.calendar import date_dimension, date_spine, spine_days
from tessera.operators.checks import (
    CheckSpec,
    DataQualityError,
    check_not_null,
    check_relationships,
    check_unique,
    check_unique_combination,
    enforce,
    null_counts,
    run_checks,
)
from tessera.operators.scd2 import build_scd2_dim, current_only, scd2_intervals
from tessera.operators.star import (
    balances_star,
    card_account_rollup,
    cards_with_accounts,
    join_as_of,
    join_calendar,
    join_current,
    loans_star,
    merge_as_of,
    spend_by_city_quarter,
    transactions_current,
    transactions_point_in_time,
    transactions_star,
)
from tessera.operators.vault import (
    Attr,
    HubSpec,
    LinkSpec,
    SatSpec,
    cast_columns,
    dedup_first,
    latest_version,
    load_hub,
    load_link,
    load_satellite,
    load_satellite_history,
    new_or_changed,
    only_new,
    satellite_incoming,
)

__all__ = [name for name in dir() if not name.startswith("_")]
