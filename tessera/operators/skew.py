"""Joins whose right side has hot keys.

Spark splits a skewed partition of the side that a left join preserves, not of the other one.  Here
the keys that hold more than ``HOT_ROWS`` rows of the right side are counted (partial sums, so that
a hot key is a row per task), their rows are dealt over ``SALTS`` parts, and the left rows of those
keys meet every part.  There are at most rows / ``HOT_ROWS`` such keys.  Counted first are ``CLASSES``
classes of keys, of which a task shuffles that many sums at most; the keys are counted in the classes
that hold more than ``HOT_ROWS`` rows, where alone a hot key can be.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.keys import packed_key, unpacked_key

#: Rows of one key beyond which they are dealt over several tasks.
HOT_ROWS = 100_000
SALTS = 32
CLASSES = 1 << 15
_LONGEST = 1 << 30


def hot_keys(right: DataFrame, key: str, hot_rows: int) -> DataFrame:
    """The keys with more than ``hot_rows`` rows, each with ``_hot``."""
    many = F.count(F.lit(1)) > hot_rows
    classed = right.withColumn("_class", F.pmod(F.xxhash64(key), F.lit(CLASSES)))
    # a row a class, CLASSES of them at most
    full = F.broadcast(classed.groupBy("_class").agg(many.alias("_full")).filter("_full").select("_class"))
    counts = classed.join(full, "_class", "left_semi").groupBy(key).agg(many.alias("_hot"))
    return counts.filter("_hot")


def left_join_salted(left: DataFrame, right: DataFrame, key: str, spread: str,
                     hot_rows: int | None = None, salts: int = SALTS,
                     extra: dict[str, Column] | None = None,
                     packed: tuple[str, ...] = ()) -> DataFrame:
    """``left`` ⟕ ``right`` on ``key``; the right rows of a hot key are dealt by the hash of
    ``spread``, one of their columns.  ``extra``: aggregates of the right rows by key to put beside
    each left row (null where there are none).  ``packed``: columns of the right side, hash keys, that
    are packed while its rows are dealt by the key, with ``extra``.

    Every right column but the key must have a name of its own.  A null key meets nothing.  Rows
    and repeats are those of a plain left join.  The left side is shuffled once, as in a plain join:
    it learns of the hot keys by a broadcast of at most (right rows) / ``hot_rows`` keys, 40 MB for
    10^11 rows.  With ``extra`` only the left rows of hot keys are shuffled, if the others lie by the
    key already."""
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    right = right.filter(F.col(key).isNotNull())
    hot = F.broadcast(hot_keys(right, key, hot_rows))
    if extra:
        # apart: rows of other keys meet by the key itself, for which a left side that lies by it is
        # not moved; the aggregates are a window over their right rows, hot_rows a key at most
        few = _dealt_packed(right.join(hot, key, "left_anti"), key, packed).withColumns(
            {n: c.over(Window.partitionBy(key)) for n, c in extra.items()})
        many = right.join(hot, key, "left_semi")
        found = F.broadcast(many.groupBy(key).agg(*[c.alias(n) for n, c in extra.items()]))
        return (left.join(hot, key, "left_anti").join(few, key, "left").unionByName(
            _salted(left.join(hot, key, "left_semi"), many, hot, key, spread, salts)
            .join(found, key, "left")))
    return _salted(left, right, hot, key, spread, salts)


def _dealt_packed(df: DataFrame, key: str, packed: tuple[str, ...]) -> DataFrame:
    """``df`` dealt by ``key``; the columns ``packed`` travel packed, the key's text is what deals."""
    if key not in packed:
        return df
    return (df.withColumns({c: packed_key(c) for c in packed}).repartition(unpacked_key(key))
            .withColumns({c: unpacked_key(c) for c in packed}))


def _salted(left: DataFrame, right: DataFrame, hot: DataFrame, key: str, spread: str,
            salts: int) -> DataFrame:
    """``left`` ⟕ ``right``, the rows of the keys in ``hot`` dealt over ``salts`` parts."""
    width = len(str(salts))

    # key and part in one column: of two columns Spark may deal by the key alone
    def place(part: Column) -> Column:
        return F.when(F.col(key).isNotNull(), F.concat(
            F.concat(F.lpad(part.cast("string"), width, "0"), F.lit("#")).cast("binary"), F.col(key).cast("binary")))

    part = F.when(F.col("_hot"), F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")).otherwise(F.lit(0))
    dealt = (right.join(hot, key, "left").withColumn("_place", place(part))
             .drop("_hot", key).withColumn("_met", F.lit(True)))
    parts = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    copies = (left.join(hot, key, "left").withColumn("_part", F.explode(parts))
              .withColumn("_place", place(F.col("_part"))))
    # a hot key has right rows: a copy that met none is one too many
    surplus = F.col("_hot").isNotNull() & F.col("_met").isNull()
    key_type, in_place = left.schema[key].dataType, F.substring("_place", width + 2, _LONGEST)
    if isinstance(key_type, (T.StringType, T.BinaryType)):  # the place holds the key, which travels once
        met = copies.drop(key).join(dealt, "_place", "left").withColumn(key, in_place.cast(key_type))
    else:
        met = copies.join(dealt, "_place", "left")
    return met.filter(~surplus).select(*left.columns, *[c for c in right.columns if c != key])
