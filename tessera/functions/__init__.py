"""Column builders: pure functions from Columns to a Column, all JVM-side."""

from tessera.functions.dates import (
    date_key,
    day_of_week_iso,
    is_month_end,
    month_start,
    padded_name,
)
from tessera.functions.keys import bounded_id, hashdiff, hub_key
from tessera.functions.tiers import credit_tier

__all__ = [
    "bounded_id",
    "credit_tier",
    "date_key",
    "day_of_week_iso",
    "hashdiff",
    "hub_key",
    "is_month_end",
    "month_start",
    "padded_name",
]
