"""Data Vault loaders: hubs, links and change-detected satellites.

All three are insert-only.  ``existing`` is the stored state (None on the
first load); the result is exactly the rows to append.

Physical shape, per load, with stored tables that are bucketed by the key of
the join (see `tessera.sources.store`):

* the stored rows that a load needs are those whose key occurs in the extract:
  a semi join that streams the stored side, pruned to a few columns, past a
  hash table of the extract's distinct keys, bucket by bucket.  Stored rows are
  neither shuffled nor sorted, whatever the sizes;
* hub / link: the first-seen dedup (row_number = 1 → WindowGroupLimit) gets
  a *partial* limit before its shuffle, so an id repeated a million times
  ships one row per map task; the anti join against the stored keys then
  shuffles only the deduplicated rows.  (An explicit repartition on the key
  would save that second, small shuffle but blocks the partial limit — a hot
  id would then ship every copy.)
* satellite: the stored rows of the extract's keys are cut to the latest per
  key where they lie; the incoming side shuffles once on the key; then a left
  join and the change filter.  Versions per key are bounded by the number of
  loads, never by data volume.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.keys import bounded_id, hashdiff, hub_key


# ---------------------------------------------------------------------------
# primitives
# ---------------------------------------------------------------------------
def dedup_first(df: DataFrame, keys: Sequence[str], order_col: str,
                tiebreak: Sequence[str] = ()) -> DataFrame:
    """Keep the first row per ``keys`` by ``order_col`` (``row_number() = 1``)."""
    order = [F.col(order_col).asc()] + [F.col(c).asc() for c in tiebreak]
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") == 1).drop("_rn"))


def latest_version(df: DataFrame, key: str | Sequence[str], order_col: str = "load_date",
                   tiebreak: Sequence[str] = ("hashdiff",)) -> DataFrame:
    """Latest row per key (``DISTINCT ON (key) … ORDER BY key, load_date DESC``)."""
    keys = [key] if isinstance(key, str) else list(key)
    order = [F.col(order_col).desc()] + [F.col(c).asc() for c in tiebreak if c in df.columns]
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") == 1).drop("_rn"))


def only_new(df: DataFrame, existing: DataFrame | None, key: str | Sequence[str]) -> DataFrame:
    """Rows whose ``key`` is not stored yet.  Written as a left-anti join (keys
    are never NULL), not ``NOT IN``, whose null-aware plan always broadcasts
    the stored keys."""
    if existing is None:
        return df
    keys = [key] if isinstance(key, str) else list(key)
    # the stored keys grow with history: always a shuffled (merge) join, never
    # a broadcast funnelled through the driver
    return df.join(existing.select(*keys).hint("merge"), on=keys, how="left_anti")


def stored_of_extract(existing: DataFrame | None, bronze: DataFrame, key: str,
                      ids: Sequence[str], buckets: int | None = None,
                      sighted: bool = False) -> DataFrame | None:
    """The stored rows whose ``key`` (the hash of ``ids``) occurs in the extract: all that a load
    needs of them.  Bucketed by ``key`` in ``buckets``, they stream past the extract's distinct keys,
    of which a task holds one bucket; the ids are made distinct and dealt, not their hash keys.
    ``sighted``: by the first sightings that a hub's or link's load ships anyway, in one shuffle."""
    if existing is None:
        return None
    if buckets is None:
        keys = bronze.select(hub_key(*ids).alias(key)).distinct()
    else:
        found = (first_sightings(bronze, ids).select(*ids) if sighted
                 else bronze.select(*ids).distinct())
        keys = _deal(found, ids, buckets).select(hub_key(*ids).alias(key))
    return existing.join(keys.hint("shuffle_hash"), key, "left_semi")


def new_or_changed(incoming: DataFrame, existing: DataFrame | None, key: str,
                   latest_only: bool = False) -> DataFrame:
    """Insert-only change detection: keep incoming rows whose key has no
    stored version or whose hashdiff differs from the *latest* stored one.
    ``latest_only`` says that ``existing`` has one row a key, so that it needs
    no ranking."""
    if existing is None:
        return incoming
    latest = existing if latest_only else latest_version(
        existing.select(key, "load_date", "hashdiff"), key)
    current = latest.select(key, F.col("hashdiff").alias("_cv_hashdiff"))
    return (incoming.join(current.hint("merge"), on=key, how="left")
            .filter(F.col("_cv_hashdiff").isNull()
                    | (F.col("hashdiff") != F.col("_cv_hashdiff")))
            .select(*incoming.columns))


_INTEGRAL = {"tinyint", "smallint", "int", "integer", "bigint", "byte", "short", "long"}


def cast_columns(df: DataFrame, casts: Sequence["Attr"], keep: Sequence[str] = ()) -> DataFrame:
    """Typed cast projection: ``keep`` columns as is, then each attribute.

    A fractional value cast to an integer type is rounded, not truncated:
    decimals half away from zero, floating point half to even (integer and
    string inputs cast as they are; a non-integral string still fails)."""
    cols = []
    for a in casts:
        src = df.schema[a.source or a.name].dataType
        if (a.dtype or "").lower() in _INTEGRAL and isinstance(src, (T.DecimalType,
                                                                     T.DoubleType,
                                                                     T.FloatType)):
            rounded = (F.round(F.col(a.source or a.name)) if isinstance(src, T.DecimalType)
                       else F.bround(F.col(a.source or a.name)))
            cols.append(rounded.cast(a.dtype).alias(a.name))
        else:
            cols.append(a.column())
    return df.select(*keep, *cols)


# ---------------------------------------------------------------------------
# specs
# ---------------------------------------------------------------------------
@dataclass(frozen=True)
class Attr:
    """Satellite attribute: output name, bronze column, optional cast type."""

    name: str
    source: str | None = None
    dtype: str | None = None

    def column(self) -> Column:
        c = F.col(self.source or self.name)
        return (c.cast(self.dtype) if self.dtype else c).alias(self.name)


@dataclass(frozen=True)
class HubSpec:
    name: str
    source: str          # bronze table
    id_col: str
    key_col: str
    width: int


@dataclass(frozen=True)
class LinkSpec:
    name: str
    source: str
    link_key: str
    hubs: tuple[tuple[str, str], ...]   # (hub key column, id column) in hash order
    # the stored rows are bucketed by this column: the link key, which no id can make hot, or the
    # key of an entity that has one link at most
    bucket_key: str | None = None

    @property
    def dealt_by(self) -> str:
        return self.bucket_key or self.link_key

    @property
    def dealt_ids(self) -> list[str]:
        """The ids that ``dealt_by`` is the hash of."""
        ids = dict(self.hubs)
        return [ids[self.bucket_key]] if self.bucket_key else list(ids.values())


@dataclass(frozen=True)
class SatSpec:
    name: str
    source: str
    id_col: str
    key_col: str
    attrs: tuple[Attr, ...] = field(default_factory=tuple)
    # keep a per-load current-state snapshot: worth it when versions per key
    # keep growing (attributes change between loads), not for event-like
    # satellites with one version per key
    snapshot: bool = False

    @property
    def attr_names(self) -> list[str]:
        return [a.name for a in self.attrs]

    @property
    def columns(self) -> list[str]:
        return [self.key_col, *self.attr_names, "hashdiff", "load_date", "record_source"]


# ---------------------------------------------------------------------------
# loaders
# ---------------------------------------------------------------------------
def _deal(df: DataFrame, ids: Sequence[str], buckets: int | None) -> DataFrame:
    """``df`` dealt over ``buckets`` by the hash key of ``ids``, as the stored table is, so that a join
    with stored rows moves it no more.  Ids travel, not their hash keys, which are computed after it."""
    return df if buckets is None else df.repartition(buckets, hub_key(*ids))


def first_sightings(bronze: DataFrame, ids: Sequence[str]) -> DataFrame:
    """The first row of each id combination of an extract, with its lineage."""
    return dedup_first(bronze.select(*ids, "_loaded_at", "record_source"), ids, "_loaded_at",
                       tiebreak=["record_source"])


def load_hub(bronze: DataFrame, spec: HubSpec, existing: DataFrame | None = None,
             buckets: int | None = None) -> DataFrame:
    """Hub rows to append: first sighting per business id, keys not stored.  They are dealt
    over ``buckets`` by the hub key."""
    first = first_sightings(bronze, [spec.id_col])
    out = _deal(first, [spec.id_col], buckets).select(
        hub_key(spec.id_col).alias(spec.key_col),
        bounded_id(spec.id_col, spec.width).alias(spec.id_col),
        F.col("_loaded_at").alias("load_date"),
        "record_source",
    )
    return only_new(out, existing, spec.key_col)


def load_link(bronze: DataFrame, spec: LinkSpec, existing: DataFrame | None = None,
              buckets: int | None = None) -> DataFrame:
    """Link rows to append: first sighting per id combination, keys not stored.  They are
    dealt over ``buckets`` by the key that the link is bucketed by."""
    ids = [id_col for _, id_col in spec.hubs]
    first = first_sightings(bronze, ids)
    # the other hub keys come after the anti join
    keys = {spec.dealt_by: hub_key(*spec.dealt_ids), spec.link_key: hub_key(*ids)}
    new = only_new(_deal(first, spec.dealt_ids, buckets)
                   .select(*ids, "_loaded_at", "record_source",
                           *[c.alias(k) for k, c in keys.items()]), existing, list(keys))
    return new.select(
        spec.link_key,
        *[F.col(hk) if hk in keys else hub_key(id_col).alias(hk) for hk, id_col in spec.hubs],
        F.col("_loaded_at").alias("load_date"),
        "record_source",
    )


def satellite_incoming(bronze: DataFrame, spec: SatSpec) -> DataFrame:
    """Cast, key and fingerprint one extract (hashdiff is taken after casts)."""
    casted = cast_columns(bronze, spec.attrs, keep=[spec.id_col, "_loaded_at", "record_source"])
    return casted.select(
        hub_key(spec.id_col).alias(spec.key_col),
        *spec.attr_names,
        hashdiff(*spec.attr_names).alias("hashdiff"),
        F.col("_loaded_at").alias("load_date"),
        "record_source",
    )


def load_satellite(bronze: DataFrame, spec: SatSpec, existing: DataFrame | None = None,
                   latest_only: bool = False, buckets: int | None = None) -> DataFrame:
    """Satellite rows to append: new keys and changed fingerprints.  No dedup
    inside one extract: a duplicated id yields two rows (the grain check
    reports it).  They are dealt over ``buckets`` by the hub key."""
    bronze = _deal(bronze, [spec.id_col], buckets)
    return new_or_changed(satellite_incoming(bronze, spec), existing, spec.key_col, latest_only)


def load_satellite_history(stacked_bronze: DataFrame, spec: SatSpec,
                           existing: DataFrame | None = None) -> DataFrame:
    """Set-based load of many extracts at once (back-fill): a row is kept when
    the previous row of its key — in load order, the stored latest version
    seeding the sequence — has another fingerprint.  Equal to loading the
    extracts one by one, because the latest stored fingerprint always equals
    the last one seen.  Extracts must carry one row per key and load stamp."""
    incoming = satellite_incoming(stacked_bronze, spec).withColumn("_seed", F.lit(False))
    if existing is not None:
        seed = (latest_version(existing.select(spec.key_col, "load_date", "hashdiff"), spec.key_col)
                .select(spec.key_col, "load_date", "hashdiff"))
        pad = [F.lit(None).cast(incoming.schema[c].dataType).alias(c)
               for c in spec.attr_names + ["record_source"]]
        seed = seed.select(spec.key_col, *pad, "hashdiff", "load_date", F.lit(True).alias("_seed"))
        incoming = incoming.unionByName(seed)
    w = Window.partitionBy(spec.key_col).orderBy("load_date")
    prev = F.lag("hashdiff").over(w)
    return (incoming.withColumn("_prev", prev)
            .filter(~F.col("_seed") & (F.col("_prev").isNull() | (F.col("_prev") != F.col("hashdiff"))))
            .select(*spec.columns))
