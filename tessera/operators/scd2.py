"""SCD Type 2 versioning of satellite history.

Each satellite row becomes a version valid on the half-open interval
``[load_date, next load_date)``; the newest version ends at 9999-12-31 and is
the current one.  The window is partitioned by the hub key, so it runs on the
same hash partitioning as the sat ⋈ hub join feeding it (no extra shuffle),
and before any parent-link fan-out.  A key has at most one version per load,
so a window group is bounded by the number of loads.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.keys import hub_key
from tessera.operators.skew import left_join_salted
from tessera.schemas import OPEN_END


def open_end():
    return F.lit(OPEN_END).cast("timestamp_ntz")


def scd2_intervals(df: DataFrame, key: str, ts: str = "load_date") -> DataFrame:
    """Add ``effective_start_date``, ``effective_end_date``, ``is_current``."""
    w = Window.partitionBy(key).orderBy(F.col(ts), F.col(key))
    nxt = F.lead(ts).over(w)
    return (df.withColumn("effective_start_date", F.col(ts))
              .withColumn("effective_end_date", F.coalesce(nxt, open_end()))
              .withColumn("is_current", nxt.isNull()))


def current_only(dim: DataFrame) -> DataFrame:
    return dim.filter(F.col("is_current"))


def build_scd2_dim(sat: DataFrame, hub: DataFrame, key: str, id_col: str,
                   attrs: Sequence[str], version_key: str,
                   parent_link: DataFrame | None = None,
                   parent_key: str | None = None) -> DataFrame:
    """Versioned dimension: satellite ⋈ hub (orphan satellite rows drop),
    intervals and the version surrogate key md5(hub key, load_date),
    optionally ⟕ a link for a parent key.

    The parent link carries no validity, so an entity linked to k parents
    fans out to k copies of each version; as in versioning *after* the fan-out,
    exactly one copy of a version carries its real interval and the other k-1
    get the zero-length interval ``[t, t)`` and are not current (the
    uniqueness checks report such entities).  The window runs *before* the
    fan-out — its groups stay bounded by the number of loads even for an
    entity with millions of parents — and the carrier copy is the one with the
    greatest parent key of the entity's links."""
    versions = (sat.select(key, *attrs, "load_date", "record_source")
                .join(hub.select(key, id_col), on=key, how="inner"))
    versioned = scd2_intervals(versions, key)
    parent_cols: list[str] = []
    if parent_link is not None:
        links = parent_link.select(key, parent_key)
        versioned = left_join_salted(versioned, links, key, spread=parent_key,
                                     extra={"_carrier": F.max(parent_key)}, packed=(key, parent_key))
        is_carrier = F.col(parent_key).eqNullSafe(F.col("_carrier"))
        versioned = (versioned
                     .withColumn("effective_end_date",
                                 F.when(is_carrier, F.col("effective_end_date"))
                                 .otherwise(F.col("effective_start_date")))
                     .withColumn("is_current", is_carrier & F.col("is_current"))
                     .drop("_carrier"))
        parent_cols = [parent_key]
    return versioned.select(
        hub_key(key, "load_date").alias(version_key),
        key, id_col, *parent_cols, *attrs,
        "effective_start_date", "effective_end_date", "is_current", "record_source",
    )
