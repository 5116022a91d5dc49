"""Distributed list ranking: positions of the elements of a linked list.

A list is a table of ``(id, next, len)``: ``next`` is the id that follows (null at the end), ``len``
how many places the element takes.  A round takes out every element whose coin is 1 and whose
predecessor's coin is 0 (about a quarter, never two neighbours): the predecessor takes over its
successor and its places.  Coins are hashes of id and round, and an element knows its predecessor,
so both neighbours learn of it in one grouping by id, of at most three rows an id.  When no more than
``tail`` elements are left they are walked in one go, and the rounds are undone backwards.  The work
over all rounds is a few times the list's size; no task ever holds more than ``tail`` elements.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Scratch

#: Elements that are walked in one go.
TAIL = 4096


def _coin(of: str, turn: int):
    return F.xxhash64(F.lit(turn), of).bitwiseAND(F.lit(1)) == 1


def _contract(links: DataFrame, turn: int) -> DataFrame:
    """One round.  ``took``: the element that was taken over, ``took_at``: its offset."""
    gone = F.col("prev").isNotNull() & _coin("id", turn) & ~_coin("prev", turn)
    none = F.lit(None).cast("bigint")

    def row(to, own, prev, nxt, length, took):
        return F.struct(to.alias("to"), F.lit(own).alias("own"), prev.alias("prev"),
                        nxt.alias("next"), length.alias("len"), took.alias("took"))

    ident, prev, nxt, length = (F.col(c) for c in ("id", "prev", "next", "len"))
    stays = F.array(row(ident, 0, prev, nxt, length, none))
    leaves = F.array(row(prev, 1, none, nxt, length, ident), row(nxt, 2, prev, none, none, none))
    sent = (links.select(F.explode(F.when(gone, leaves).otherwise(stays)).alias("m"))
            .select("m.*").filter(F.col("to").isNotNull()))

    def of(own, col):
        return F.max(F.when(F.col("own") == own, F.col(col)))

    got = sent.groupBy(F.col("to").alias("id")).agg(
        of(0, "next").alias("next0"), of(0, "prev").alias("prev0"), of(0, "len").alias("len0"),
        of(1, "next").alias("next1"), of(1, "len").alias("len1"), of(1, "took").alias("took"),
        of(2, "prev").alias("prev2"))
    took = F.col("took").isNotNull()
    return got.select(
        "id", F.coalesce("prev2", "prev0").alias("prev"),
        F.when(took, F.col("next1")).otherwise(F.col("next0")).alias("next"),
        (F.col("len0") + F.coalesce("len1", F.lit(0))).alias("len"),
        "took", F.when(took, F.col("len0")).alias("took_at"))


def list_rank(scratch: Scratch, links: DataFrame, tail: int = TAIL) -> DataFrame:
    """(id, start) of every element: the places before it.  ``links`` holds one or more lists,
    ids are unique; an empty table gives an empty one.  Ids that no list reaches cannot occur."""
    spark = scratch.spark
    prevs = links.filter("next IS NOT NULL").select(F.col("next").alias("id"), F.col("id").alias("prev"))
    left = scratch.write(links.select("id", "next", F.col("len").cast("bigint").alias("len"))
                         .join(prevs, "id", "left").select("id", "prev", "next", "len"), "links")
    rounds = []
    while left.count() > tail:
        rounds.append(scratch.write(_contract(left, len(rounds)), f"round_{len(rounds)}"))
        left = rounds[-1].select("id", "prev", "next", "len")
    rows = {r.id: r for r in left.collect()}  # at most ``tail``
    starts = []
    for head in (r for r in rows.values() if r.prev is None):
        at = 0
        while head is not None:
            starts.append((head.id, at))
            at += head.len
            head = rows.get(head.next)
    out = spark.createDataFrame(starts, "id bigint, start bigint")
    for k in range(len(rounds) - 1, -1, -1):
        both = F.array(F.struct("id", "start"),
                       F.struct(F.col("took").alias("id"), (F.col("start") + F.col("took_at")).alias("start")))
        out = scratch.write(out.join(rounds[k].select("id", "took", "took_at"), "id")
                            .select(F.explode(both).alias("s")).select("s.*")
                            .filter("id IS NOT NULL"), f"starts_{k}")
    return out
