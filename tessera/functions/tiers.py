"""Credit-score bucketing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.schemas import CREDIT_TIER_ELSE, CREDIT_TIERS


def credit_tier(score: str | Column) -> Column:
    """Searched CASE over the cut points, first match wins; NULL falls through
    to the last tier like any score below the lowest cut point."""
    s = F.col(score) if isinstance(score, str) else score
    (first_cut, first_name), *rest = CREDIT_TIERS
    expr = F.when(s >= first_cut, first_name)
    for cut, name in rest:
        expr = expr.when(s >= cut, name)
    return expr.otherwise(CREDIT_TIER_ELSE)
