"""Conversation prefix trie by the Euler-tour technique.

Conversations that open with the same turns share a path of a trie.  For each node the operator
counts the conversations through it, the leaves below it, and the words that need not be stored or
computed again because the node's turn is shared.

1. **Paths.**  Turns are dealt in slices, ranges of (conversation, turn), so that a conversation of
   any length is spread over tasks.  A scan of each slice numbers the turns and hashes each prefix
   (a polynomial modulo 2^127-1 over digests of role and text); what a slice needs of those before
   it is one row a slice.  Equal prefix hashes are one node: ``groupBy`` with partial aggregation,
   so that a first turn of a third of all conversations is a few rows.
2. **Tour.**  Each node has an enter and an exit arc; children follow in order of their least
   conversation.  Next siblings come from a sorted scan, first children from a grouping, so that a
   node may have any number of children.
3. **List ranking.**  Stretches of the tour inside a cell (neighbouring nodes of the slices by
   conversation and depth) become one element each; `ranking.list_rank` ranks the elements.
4. **Prefix sums** of leaves and savings over the tour's positions, in buckets of equal size; the
   difference between a node's two arcs is its subtree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, n_words, ship, shuffle_partitions
from tessera.llm.ranking import TAIL, list_rank

#: Nodes whose part of the tour is walked in one go.
CELL = 50_000
#: Positions of the tour that are summed in one window.
BUCKET = 65_536
#: Text of joined ids that travels in one row.
PIECE = 16_384

PRIME = (1 << 127) - 1
BASE = int.from_bytes(hashlib.sha256(b"prefix").digest()[:15], "big") | 1
ROOT = bytes(16)
NO_ENDS = hashlib.sha256(b"").hexdigest()


def turn_item(role: Column, text: Column) -> Column:
    """16 bytes of the SHA-256 of a turn; the role's length keeps role and text apart."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.unhex(F.substring(F.sha2(whole, 256), 1, 32))


def _slice() -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId()


def _scan(rows: DataFrame, by: list, work: Callable, schema: str) -> DataFrame:
    """``work`` over the rows of each slice, sorted by ``by``; slices are ranges of ``by``."""
    parts = shuffle_partitions(rows.sparkSession)
    return rows.repartitionByRange(parts, *by).sortWithinPartitions(*by).mapInArrow(work, schema)


def _runs(values: np.ndarray) -> np.ndarray:
    """Where a value differs from the one before it."""
    return np.concatenate([[True], values[1:] != values[:-1]])


# -- 1. paths ----------------------------------------------------------------------------------
def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the turns of each conversation of a slice; a last row has the slice's last one."""
    at, last, n = _slice(), None, 0
    names = ["slice", "conv", "pos", "item", "words", "tail"]
    for batch in batches:
        conv = batch.column("conv").to_numpy()
        if not len(conv):
            continue
        rows = np.arange(len(conv))
        start = np.maximum.accumulate(np.where(_runs(conv), rows, 0))
        pos = rows - start
        if conv[0] == last:
            pos[: len(conv) if conv[-1] == last else int(np.argmax(conv != last))] += n
        last, n = conv[-1], int(pos[-1]) + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(conv), at, np.int32)), batch.column("conv"),
             pa.array(pos.astype(np.int64)), batch.column("item"), batch.column("words"),
             pa.array(np.zeros(len(conv), bool))], names=names)
    if last is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array([at], pa.int32()), pa.array([last], pa.int64()), pa.array([n], pa.int64()),
             pa.array([None], pa.binary()), pa.array([None], pa.int64()), pa.array([True])],
            names=names)


def numbered_turns(scratch: Scratch, turns: DataFrame) -> DataFrame:
    """(conv, pos, item, words) of turns given as (conv, turn, role, item, words).  Turns go by
    number, nulls first, then by role and by digest; equal rows stay, as turns of their own."""
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("item")]
    # equal rows may be many: any order of them is the same, and the row number spreads them
    rows = turns.withColumn("nth", F.monotonically_increasing_id())
    found = scratch.write(_scan(rows, [*order, F.col("nth")], _number,
                                "slice int, conv long, pos long, item binary, words long, tail boolean"),
                          "numbered", by="tail")
    carry, before = [], {}
    for r in sorted(found.filter("tail").collect()):  # a row a slice
        if before:
            carry.append((r.slice, before["conv"], before["n"]))
        n = r.pos + (before["n"] if before and before["conv"] == r.conv else 0)
        before = {"conv": r.conv, "n": n}
    more = scratch.spark.createDataFrame(carry, "slice int, conv long, more long")
    return (found.filter("NOT tail").join(F.broadcast(more), ["slice", "conv"], "left")
            .select("conv", (F.col("pos") + F.coalesce("more", F.lit(0))).alias("pos"), "item", "words"))


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Depths and prefix hashes as if each slice were the first; a last row has the last ones."""
    at, last, d, h = _slice(), None, 0, 0
    names = ["slice", "conv", "depth", "key", "parent", "words", "tail"]
    for batch in batches:
        conv, depth, keys, parents = batch.column("conv").to_pylist(), [], [], []
        for c, item in zip(conv, batch.column("item").to_pylist(), strict=True):
            if c != last:
                last, d, h = c, 0, 0
            parents.append(h.to_bytes(16, "big"))
            d, h = d + 1, (h * BASE + int.from_bytes(item, "big") + 1) % PRIME
            depth.append(d)
            keys.append(h.to_bytes(16, "big"))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(conv), at, np.int32)), batch.column("conv"),
             pa.array(depth, pa.int64()), pa.array(keys, pa.binary()),
             pa.array(parents, pa.binary()), batch.column("words"),
             pa.array(np.zeros(len(conv), bool))], names=names)
    if last is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array([at], pa.int32()), pa.array([last], pa.int64()), pa.array([d], pa.int64()),
             pa.array([h.to_bytes(16, "big")], pa.binary()), pa.array([None], pa.binary()),
             pa.array([None], pa.int64()), pa.array([True])], names=names)


def _continue(carry: dict[int, tuple[int, int, int]]) -> Callable:
    """Put the slices' prefix hashes together: ``carry`` has, by slice, the conversation that
    began before it, its depth and its hash there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slices, convs = batch.column("slice").to_pylist(), batch.column("conv").to_pylist()
            depth, keys, parents = (batch.column(c).to_pylist() for c in ("depth", "key", "parent"))
            for k, (s, c) in enumerate(zip(slices, convs, strict=True)):
                if s in carry and carry[s][0] == c:
                    _, more, h = carry[s]
                    up = h * pow(BASE, depth[k] - 1, PRIME) % PRIME
                    parents[k] = ((up + int.from_bytes(parents[k], "big")) % PRIME).to_bytes(16, "big")
                    keys[k] = ((up * BASE + int.from_bytes(keys[k], "big")) % PRIME).to_bytes(16, "big")
                    depth[k] += more
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), pa.array(depth, pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(parents, pa.binary()), batch.column("words")],
                names=["conv", "depth", "key", "parent", "words"])

    return run


def _paths(scratch: Scratch, steps: DataFrame) -> DataFrame:
    """(conv, depth, key, parent, words) for every turn of (conv, place..., item, words)."""
    found = scratch.write(_scan(steps, [F.col("conv"), F.col("part"), F.col("pos")], _hash,
                                "slice int, conv long, depth long, key binary, parent binary, "
                                "words long, tail boolean"), "hashed", by="tail")
    carry, before = {}, None
    for r in sorted(found.filter("tail").select("slice", "conv", "depth", "key").collect()):
        d, h = r.depth, int.from_bytes(r.key, "big")
        if before:
            carry[r.slice] = before
            if before[0] == r.conv:
                h = (before[2] * pow(BASE, d, PRIME) + h) % PRIME
                d += before[1]
        before = (r.conv, d, h)
    rows = found.filter("NOT tail").select("slice", "conv", "depth", "key", "parent", "words")
    return scratch.write(rows.mapInArrow(_continue(carry),
                                         "conv long, depth long, key binary, parent binary, words long"),
                         "paths")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of a key, joined by commas, in pieces; each id is followed by a comma."""
    at, n, last, held, size = _slice(), 0, None, [], 0
    rows: list[tuple] = []

    def close() -> None:
        nonlocal n, held, size
        if held:
            rows.append((last, at, n, ",".join(held) + ","))
            n, held, size = n + 1, [], 0

    def batch_of() -> pa.RecordBatch:
        cols = list(zip(*rows, strict=True)) or [[]] * 4
        kinds = (pa.binary(), pa.int32(), pa.int64(), pa.string())
        rows.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                          names=["key", "slice", "nth", "piece"])

    for batch in batches:
        for key, conv in zip(batch.column("key").to_pylist(), batch.column("conv").to_pylist(),
                             strict=True):
            if key != last or size >= PIECE:
                close()
            last = key
            held.append(str(conv))
            size += len(held[-1]) + 1
        yield batch_of()
    close()
    yield batch_of()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the pieces of each key, as they come, without the last comma."""
    last, sha, comma = None, None, b""
    for batch in batches:
        done = []
        for key, piece in zip(batch.column("key").to_pylist(), batch.column("piece").to_pylist(),
                              strict=True):
            if key != last:
                if last is not None:
                    done.append((last, sha.hexdigest()))
                last, sha, comma = key, hashlib.sha256(), b""
            sha.update(comma + piece[:-1].encode())
            comma = b","
        yield _digest_rows(done)
    if last is not None:
        yield _digest_rows([(last, sha.hexdigest())])


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [[], []]
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.string())],
                                      names=["key", "ends_sha256"])


def _ends(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256): the digest of the ids that end at a node.  A digest runs over its text
    in order, so one task reads it, but in pieces of many ids, and holds one at a time."""
    pieces = _scan(ends, [F.col("key"), F.col("conv")], _pieces,
                   "key binary, slice int, nth long, piece string")
    return (pieces.repartition("key").sortWithinPartitions("key", "slice", "nth")
            .mapInArrow(_digests, "key binary, ends_sha256 string"))


# -- 2. tour -----------------------------------------------------------------------------------
def _siblings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The next child of the same parent; a slice's first row goes into a row of its own, and its
    last row waits for that of the next slice (``open``)."""
    at, held, first = _slice(), None, True
    names = ["slice", "key", "parent", "next", "open", "tail"]
    kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.bool_(), pa.bool_())

    def rows(items: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*items, strict=True)) or [[]] * 6
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                          names=names)

    for batch in batches:
        out = []
        for key, parent in zip(batch.column("key").to_pylist(), batch.column("parent").to_pylist(),
                               strict=True):
            if first:
                out.append((at, key, parent, None, False, True))
                first = False
            if held:
                out.append((at, *held, key if held[1] == parent else None, False, False))
            held = (key, parent)
        yield rows(out)
    if held:
        yield rows([(at, *held, None, True, False)])


def _next_siblings(scratch: Scratch, nodes: DataFrame) -> DataFrame:
    found = scratch.write(_scan(nodes.select("key", "parent", "conv"),
                                [F.col("parent"), F.col("conv")], _siblings,
                                "slice int, key binary, parent binary, next binary, open boolean, "
                                "tail boolean"), "siblings", by="tail")
    firsts = sorted((r.slice, r.key, r.parent) for r in found.filter("tail").collect())
    after = [(a[0], bytes(b[2]), bytes(b[1])) for a, b in zip(firsts[:-1], firsts[1:], strict=True)]
    after = scratch.spark.createDataFrame(after, "slice int, parent binary, first binary")
    return (found.filter("NOT tail").join(F.broadcast(after), ["slice", "parent"], "left")
            .select("key", F.when(F.col("open"), F.col("first")).otherwise(F.col("next")).alias("next")))


#: Of nodes: both arcs' elements and offsets.  Of elements (tail): the head arc, the arc that
#: follows, and the number of arcs.  An arc is a key and a byte: ``<`` enter, ``>`` exit.
_TOUR = ("key binary, enter_in long, enter_at long, exit_in long, exit_at long, "
         "head binary, follows binary, tail boolean")
_TOUR_KINDS = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(),
               pa.bool_())
_TOUR_NAMES = [c.split()[0] for c in _TOUR.split(", ")]


def _walk(cell: int) -> Callable:
    """Stretches of the tour inside cells of at most ``cell`` nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, rows = _slice() << 40, []
        for batch in batches:
            rows += zip(*(batch.column(c).to_pylist() for c in ("key", "parent", "child", "next")),
                        strict=True)
            while len(rows) >= cell:
                out, n = _stretches(rows[:cell], n)
                yield out
                rows = rows[cell:]
        if rows:
            yield _stretches(rows, n)[0]

    return run


def _stretches(nodes: list[tuple], n: int) -> tuple[pa.RecordBatch, int]:
    """Arcs 2k (enter) and 2k+1 (exit) of node k, followed as far as the cell goes."""
    at = {node[0]: k for k, node in enumerate(nodes)}
    after, outside = [-1] * (2 * len(nodes)), [None] * (2 * len(nodes))
    inner = bytearray(2 * len(nodes))
    for k, (key, parent, child, sibling) in enumerate(nodes):
        for arc, to, way in ((2 * k, child or key, 0 if child else 1),
                             (2 * k + 1, sibling or parent, 0 if sibling else 1)):
            if to is None:  # the root's exit
                continue
            if to in at:
                after[arc] = 2 * at[to] + way
                inner[after[arc]] = 1
            else:
                outside[arc] = to + b"<>"[way : way + 1]
    element, offset = [0] * len(after), [0] * len(after)
    tails = []
    for head in (a for a in range(len(after)) if not inner[a]):
        arc, length = head, 0
        while True:
            element[arc], offset[arc] = n, length
            length += 1
            if after[arc] < 0:
                break
            arc = after[arc]
        key = nodes[head // 2][0] + b"<>"[head % 2 : head % 2 + 1]
        tails.append((None, n, length, None, None, key, outside[arc], True))
        n += 1
    cols = [[node[0] for node in nodes], element[::2], offset[::2], element[1::2], offset[1::2],
            [None] * len(nodes), [None] * len(nodes), [False] * len(nodes)]
    cols = [a + list(b) for a, b in zip(cols, zip(*tails, strict=True), strict=True)]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(cols, _TOUR_KINDS, strict=True)], names=_TOUR_NAMES), n


def tour_positions(scratch: Scratch, nodes: DataFrame, cell: int, tail: int) -> DataFrame:
    """(key, enter, exit): places of the arcs of nodes (key, parent, child, next, conv, depth)."""
    tour = scratch.write(_scan(nodes.select("key", "parent", "child", "next", "conv", "depth"),
                               [F.col("conv"), F.col("depth")], _walk(cell), _TOUR), "tour", by="tail")
    elements = tour.filter("tail").select(F.col("enter_in").alias("id"), F.col("enter_at").alias("len"),
                                          "head", "follows")
    heads = elements.select(F.col("head").alias("follows"), F.col("id").alias("next"))
    starts = list_rank(scratch, elements.join(heads, "follows", "left").select("id", "next", "len"), tail)
    arcs = tour.filter("NOT tail")
    for way in ("enter", "exit"):
        arcs = arcs.join(starts.select(F.col("id").alias(f"{way}_in"), F.col("start").alias(f"{way}_s")),
                         f"{way}_in")
    return arcs.select("key", (F.col("enter_s") + F.col("enter_at")).alias("enter"),
                       (F.col("exit_s") + F.col("exit_at")).alias("exit"))


# -- 4. sums -----------------------------------------------------------------------------------
def _subtree_sums(scratch: Scratch, placed: DataFrame, sums: list[str], bucket: int) -> DataFrame:
    """(key, sums...) over each node's subtree, of nodes (key, enter, exit, sums...)."""
    arcs = scratch.write(placed.select("key", F.explode(F.array(
        F.struct(F.col("enter").alias("place"), *sums, F.lit(True).alias("enters")),
        F.struct(F.col("exit").alias("place"), *[F.lit(0).cast("bigint").alias(c) for c in sums],
                 F.lit(False).alias("enters")))).alias("a")).select("key", "a.*")
        .withColumn("bucket", F.floor(F.col("place") / F.lit(bucket))), "arcs")
    inside = Window.partitionBy("bucket").orderBy("place")
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = (arcs.groupBy("bucket").agg(*[F.sum(c).alias(f"{c}_of") for c in sums])  # a row a bucket
             .select("bucket", *[F.coalesce(F.sum(f"{c}_of").over(before), F.lit(0)).alias(f"{c}_base")
                                 for c in sums]))
    running = (arcs.select("key", "bucket", "enters", *sums,
                           *[F.sum(c).over(inside).alias(f"{c}_run") for c in sums])
               .join(bases, "bucket"))
    # all up to the exit, less all before the enter
    part = [F.sum(F.when(F.col("enters"), F.col(c) - F.col(f"{c}_run") - F.col(f"{c}_base"))
                  .otherwise(F.col(f"{c}_run") + F.col(f"{c}_base"))).alias(c) for c in sums]
    return running.groupBy("key").agg(*part)


# -- the operator ------------------------------------------------------------------------------
def shared_openings(numbered: DataFrame, convs: DataFrame, family: int, most: int) -> DataFrame:
    """(conv, part, pos, item, words): conversation c with its first h turns replaced by those of
    conversation c - c % family; h is the CRC-32 of c's decimal id modulo ``most`` + 1."""
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % (most + 1)
    own = numbered.filter(F.col("pos") >= h).select("conv", F.lit(1).alias("part"), "pos", "item", "words")
    heads = numbered.filter(F.col("pos") < most).select(
        F.col("conv").alias("base"), F.col("pos"), "item", "words")  # at most ``most`` rows a base
    asks = convs.select("conv", h.alias("h"), (F.col("conv") - F.col("conv") % family).alias("base"))
    lent = (asks.filter("h > 0").join(heads, "base").filter(F.col("pos") < F.col("h"))
            .select("conv", F.lit(0).alias("part"), "pos", "item", "words"))
    return own.unionByName(lent)


def prefix_trie(spark: SparkSession, turns: DataFrame, family: int | None = None, most: int = 3,
                cell: int = CELL, bucket: int = BUCKET, tail: int = TAIL) -> DataFrame:
    """Trie nodes of conversations given as turns (conv_id, turn, role, text, ...).

    One row a node: ``conv_id`` (its smallest conversation; the node is that conversation's first
    ``depth`` turns), ``depth``, ``parent_conv_id`` (null at the root), ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens``, ``ends_sha256``, and the places ``enter`` and ``exit`` of its arcs
    in the tour.  A node's descendants are the nodes between its two places.

    ``family``: first give every conversation the opening turns of its family's first one, as
    `shared_openings` says; without it conversations are taken as they are.

    Nulls: a null conv_id names no conversation, its rows are left out; a null role or text is
    empty; null turns come first.  Turns of equal number go by role, then by digest of the turn;
    repeated rows are turns of their own.  An empty table gives no row, not even a root.  Other
    columns are ignored, whatever their names.  Texts may be of any length: they leave a digest and
    a word count before anything is shuffled."""
    ship(spark)
    scratch = Scratch(spark, "trie")
    rows = turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv"), F.col("turn"),
        F.coalesce("role", F.lit("")).alias("role"), turn_item(F.col("role"), F.col("text")).alias("item"),
        n_words(F.col("text")).cast("bigint").alias("words"))
    numbered = numbered_turns(scratch, rows)
    convs = scratch.write(numbered.groupBy("conv").agg(F.count(F.lit(1)).alias("turns")), "convs")
    if family is None:
        steps = numbered.select("conv", F.lit(0).alias("part"), "pos", "item", "words")
    else:
        steps = shared_openings(numbered, convs, family, most)
    paths = _paths(scratch, steps)
    last = paths.groupBy("conv").agg(F.max_by("key", "depth").alias("key"))
    root = F.lit(ROOT)
    ends = _ends(convs.join(last, "conv", "left").select(F.coalesce("key", root).alias("key"), "conv"))

    nodes = paths.groupBy("key").agg(
        F.first("parent").alias("parent"), F.first("depth").alias("depth"),
        F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv"), F.first("words").alias("words"))
    top = (convs.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv"))
           .filter("n_convs > 0").select(
               root.alias("key"), F.lit(None).cast("binary").alias("parent"),
               F.lit(0).cast("bigint").alias("depth"), "n_convs", "conv", F.lit(0).cast("bigint").alias("words")))
    nodes = scratch.write(nodes.unionByName(top), "nodes")
    inner = nodes.filter("parent IS NOT NULL")
    children = inner.groupBy(F.col("parent").alias("key")).agg(
        F.count(F.lit(1)).alias("n_children"), F.min_by("key", "conv").alias("child"))
    linked = scratch.write(
        nodes.join(_next_siblings(scratch, inner), "key", "left").join(children, "key", "left")
        .join(nodes.select(F.col("key").alias("parent"), F.col("conv").alias("parent_conv")), "parent", "left")
        .withColumn("n_children", F.coalesce("n_children", F.lit(0)))
        .withColumn("n_leaves", (F.col("n_children") == 0).cast("bigint"))
        .withColumn("saved_tokens", (F.col("n_convs") - 1) * F.col("words")), "linked")

    places = scratch.write(tour_positions(scratch, linked, cell, tail), "places")
    sums = _subtree_sums(scratch, linked.join(places, "key").select(
        "key", "enter", "exit", "n_leaves", "saved_tokens"), ["n_leaves", "saved_tokens"], bucket)
    out = (linked.drop("n_leaves", "saved_tokens").join(places, "key").join(sums, "key")
           .join(ends, "key", "left")
           .select(F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"),
                   "n_convs", F.col("n_children").cast("bigint").alias("n_children"), "n_leaves",
                   "saved_tokens", F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
                   "enter", "exit"))
    out = scratch.write(out, "trie")
    scratch.keep("trie")
    return out
