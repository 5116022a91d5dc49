"""Hash keys of the vault.

A key is the md5 of the key parts rendered as text, NULL parts replaced by a
fixed token, joined with '-'.  Consequences worth knowing: the key is never
NULL, NULL and '' give different keys, the part order matters, and the
separator is not escaped.  Parts must be strings, integers, decimals, dates or
timestamps (doubles render differently across engines).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.schemas import KEY_SEPARATOR, NULL_TOKEN


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hub_key(*parts: str | Column) -> Column:
    """md5 surrogate key over one or more parts (hub, link and version keys)."""
    if not parts:
        raise ValueError("hub_key needs at least one column")
    texts = [F.coalesce(_col(p).cast("string"), F.lit(NULL_TOKEN)) for p in parts]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *texts))


_PAD = 17  # one more than a packed md5 has bytes


def packed_key(c: str | Column) -> Column:
    """A key as it travels in a shuffle: the 16 bytes of an md5 instead of its 32 digits, which no
    shuffle codec shrinks.  Any other text is its bytes and 17 zeros, so that no two keys meet."""
    c = _col(c)
    md5 = F.unhex(c)
    return (F.when((F.length(c) == 32) & (F.lower(F.hex(md5)) == c), md5)
            .otherwise(F.concat(c.cast("binary"), F.lit(b"\0" * _PAD))))


def unpacked_key(c: str | Column) -> Column:
    """The key that `packed_key` packed."""
    c = _col(c)
    text = F.substring(c, F.lit(1), F.length(c) - _PAD)
    return F.when(F.length(c) == 16, F.lower(F.hex(c))).otherwise(F.decode(text, "utf-8"))


def hashdiff(*attributes: str | Column) -> Column:
    """Fingerprint of a satellite's descriptive attributes (after casting)."""
    return hub_key(*attributes)


def bounded_id(c: str | Column, width: int) -> Column:
    """``varchar(width)`` semantics: the text, cut to ``width`` characters."""
    return F.substring(_col(c).cast("string"), 1, width)
