"""Bronze: the raw extract, columns passed through untouched, plus lineage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.schemas import RECORD_SOURCE


def select_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Explicit projection of a ``select *`` source (extra columns drop,
    missing ones fail at analysis)."""
    return df.select(*columns)


def extract_bronze(df: DataFrame, columns: Sequence[str],
                   loaded_at: Column | str | None = None,
                   record_source: str = RECORD_SOURCE) -> DataFrame:
    """Named columns as is (no cast, no trim, no rename) + ``record_source``
    + ``_loaded_at``.  ``loaded_at`` is one constant per extract; pass it for
    reproducible loads, or leave it None for the session's local time."""
    if loaded_at is None:
        stamp = F.localtimestamp()
    elif isinstance(loaded_at, str):
        stamp = F.lit(loaded_at).cast("timestamp_ntz")
    else:
        stamp = loaded_at.cast("timestamp_ntz")
    return select_columns(df, columns).select(
        *columns,
        F.lit(record_source).alias("record_source"),
        stamp.alias("_loaded_at"),
    )
