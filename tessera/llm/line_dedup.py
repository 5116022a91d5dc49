"""Line dedup: drop each line that equals, or is within an edit of, an earlier line.

Method: deletion-neighbourhood join, over words.  A line emits hashed keys of all its variants
within the edit bound: itself, and itself without each of its words.  Lines that share a variant
are joined, their edit distance is verified, and the earliest stays.

* Two lines that differ by a substitution share the variant without that word *and* its place; two
  that differ by an inserted word share the shorter line itself.  Keys therefore carry the role
  (whole line, deletion, deletion at a place), and whoever shares a key of fitting roles is a
  neighbour.  The earliest line of a key is compared with each other line of it: a star, no pairs.
* Variants need as many keys as words, so lines that can have no neighbour leave first: two lines
  within an edit share their first or their last half (of the shorter line's words).  A line whose
  halves no other line has emits no variants; this loses nothing.
* Equal lines collapse before all that, and only the earliest occurrence emits.

Keys and answers travel by the block exchange (``blocks.py``).  Lines that share a variant meet by
number, each key once a line however often the line repeats it; only the pairs that the stars have
chosen are joined with their texts, for verification.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.blocks import Block, Blocks, answer, groups, said
from tessera.llm.common import Scratch
from tessera.llm.hashing import mix, powers, span_hashes, word_spans

BLOCK_BYTES = 2 << 20
WHOLE, DELETION, PLACE = 0, 1, 2  # roles of a key
_LINE, _HALF = 0, 1               # kinds of a key of the first exchange
_MARK = np.dtype([("doc", "<i8"), ("kind", "u1")])
_FINISHED = pa.schema([("text", pa.binary()), ("n_lines", pa.int64()), ("n_copies", pa.int64()),
                       ("n_near", pa.int64()), ("kept_sha256", pa.string())])
_NO_ID = np.iinfo(np.int64).max
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _salt(x: int) -> np.uint64:
    return mix(np.array([x], dtype=np.uint64))[0]


class Lines:
    """The lines of a block and polynomial hashes of their words."""

    def __init__(self, block: Block, min_words: int, near_words: int):
        self.block, self.near_words = block, near_words
        data = _LOWER[block.data]
        self.end = np.flatnonzero(data == 10)
        self.start = np.concatenate([[0], self.end[:-1] + 1]) if len(self.end) else self.end
        self.doc = np.searchsorted(block.starts, self.start, side="right") - 1
        starts, ends = word_spans(data)
        tokens = span_hashes(data, starts, ends)
        self.a = np.searchsorted(starts, self.start)
        self.b = np.searchsorted(starts, self.end)
        self.n = self.b - self.a
        up, self.down = powers(len(tokens) + 2)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(tokens * up[: len(tokens)])])
        other = mix(tokens ^ _salt(1))
        self.other = np.concatenate([np.zeros(1, np.uint64), np.cumsum(other)])
        ids = np.array([_NO_ID if i is None else i for i in block.ids], dtype=np.int64)
        self.id = ids[self.doc]
        rank = np.empty(len(ids), dtype=np.int64)
        rank[np.argsort(ids, kind="stable")] = np.arange(len(ids))
        #: lines that count, in order of document id and place
        used = np.flatnonzero(self.n >= min_words)
        self.used = used[np.argsort(rank[self.doc[used]], kind="stable")]

    def hash(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Hash of words a to b."""
        return mix((self.sums[b] - self.sums[a]) * self.down[a] + (b - a).astype(np.uint64))

    # first exchange ------------------------------------------------------------------------------
    def lines(self):
        """Distinct lines: key, second hash, first occurrence, and each used line's number."""
        a, b = self.a[self.used], self.b[self.used]
        keys, more = self.hash(a, b), mix(self.other[b] - self.other[a])
        order, starts = groups(keys, more)
        of = np.empty(len(keys), dtype=np.int64)
        of[order] = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(keys))))
        first = order[starts]
        return keys[first], more[first], self.used[first], of

    def halves(self, lines: np.ndarray):
        """Keys of the first and last halves of lines, and the line of each."""
        lines = lines[self.n[lines] >= self.near_words]
        a, b, n = self.a[lines], self.b[lines], self.n[lines]
        keys, of = [], []
        for length, on in ((n // 2, slice(None)), ((n - 1) // 2, (n % 2 == 0))):
            for kind, x, y in ((3, a, a + length), (4, b - length, b)):
                keys.append(mix(self.hash(x[on], y[on]) ^ _salt(kind)))
                of.append(lines[on])
        return np.concatenate(keys), np.concatenate(of)

    def first_keys(self):
        """All keys of the first exchange, ascending, with the way back to lines."""
        key, more, line, of = self.lines()
        half, half_line = self.halves(line)
        whole = np.empty(len(self.n), dtype=np.uint64)
        whole[line] = key
        order = np.lexsort((whole[half_line], half))
        h, w = half[order], whole[half_line][order]
        starts = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.empty(
            0, np.int64)
        ends = np.append(starts[1:], len(h))
        half_of = np.empty(len(h), dtype=np.int64)
        half_of[order] = np.repeat(np.arange(len(starts)), ends - starts)
        marks = np.empty(len(key) + len(starts), dtype=_MARK)
        marks["doc"][: len(key)], marks["kind"][: len(key)] = self.id[line], _LINE
        several = w[starts] != w[ends - 1] if len(h) else np.empty(0, bool)
        marks["doc"][len(key) :], marks["kind"][len(key) :] = several, _HALF
        keys = np.concatenate([key, h[starts]])
        mores = np.concatenate([more, w[starts]])
        ascending = np.lexsort((marks["kind"], mores, keys))
        back = np.empty(len(keys), dtype=np.int64)
        back[ascending] = np.arange(len(keys))
        return (keys[ascending], mores[ascending], marks[ascending], back[: len(key)], of, line,
                back[len(key) :][half_of], half_line)

    def after_first(self, known: dict) -> None:
        """``copies``: lines that occurred before.  ``open``: first occurrences whose halves
        another line shares."""
        keys, _, _, line_at, of, first, half_at, half_line = self.first_keys()
        got = said(known, "first", len(keys))
        again = self.used != first[of]
        self.copies = self.used[again | (got[line_at][of] > 0)]
        fresh = np.zeros(len(self.n), dtype=bool)
        fresh[first[got[line_at] == 0]] = True
        shared = np.zeros(len(self.n), dtype=bool)
        shared[half_line[got[half_at] > 0]] = True
        self.open = np.flatnonzero(fresh & shared)

    # second exchange -----------------------------------------------------------------------------
    def variants(self):
        """(key, role, line) of all variants of the open lines."""
        line = self.open
        a, b, n = self.a[line], self.b[line], self.n[line]
        of = np.repeat(np.arange(len(line)), n)
        place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        at, x, y = a[of] + place, a[of], b[of]
        rest = ((self.sums[at] - self.sums[x]) * self.down[x]
                + (self.sums[y] - self.sums[at + 1]) * self.down[x + 1])
        rest = mix(rest + (n[of] - 1).astype(np.uint64))
        whole = self.hash(a, b)
        keys = np.concatenate([mix(whole ^ _salt(5)), mix(rest ^ _salt(5)),
                               mix(rest ^ mix(place.astype(np.uint64) + np.uint64(1 << 32)))])
        role = np.repeat(np.array([WHOLE, DELETION, PLACE], dtype=np.uint8),
                         [len(line), len(of), len(of)])
        return keys, role, np.concatenate([line, line[of], line[of]])

    def second_keys(self):
        """Distinct (key, role), the mark says that several lines have it; way back and lines."""
        keys, role, line = self.variants()
        order, starts = groups(keys, role)
        size = np.diff(np.append(starts, len(keys)))
        of = np.empty(len(keys), dtype=np.int64)
        of[order] = np.repeat(np.arange(len(starts)), size)
        return keys[order][starts], role[order][starts], (size > 1).astype(np.uint8), of, keys, line


def _decide_first(keys, more, marks, row):
    """Lines: 1 if it occurred in an earlier document.  Halves: 1 if two lines have it."""
    out = np.zeros(len(keys), dtype=np.uint8)
    line = np.flatnonzero(marks["kind"] == _LINE)
    if len(line):
        line = line[np.argsort(marks["doc"][line], kind="stable")]
        order, starts = groups(keys[line], more[line])
        out[line] = 1
        out[line[order[starts]]] = 0
    half = np.flatnonzero(marks["kind"] == _HALF)
    if len(half):
        order, starts = groups(keys[half])
        size = np.diff(np.append(starts, len(half)))
        m = more[half][order]
        several = ((np.minimum.reduceat(m, starts) != np.maximum.reduceat(m, starts))
                   | (np.maximum.reduceat(marks["doc"][half][order], starts) > 0))
        out[half[order]] = np.repeat(several, size)
    return out


def _decide_second(keys, more, marks, row):
    """1 for a place that several lines have, and for a whole line or a deletion that meet."""
    order, starts = groups(keys)
    size = np.diff(np.append(starts, len(keys)))
    role = more[order]
    several = (size > 1) | (np.maximum.reduceat(marks[order], starts) > 0)
    low, high = np.minimum.reduceat(role, starts), np.maximum.reduceat(role, starts)
    meet = np.where(high == PLACE, several, low != high)
    out = np.empty(len(keys), dtype=np.uint8)
    out[order] = np.repeat(meet, size)
    return out


def within_one_edit(a: list, b: list) -> bool:
    """Whether two word lists differ by at most one inserted, deleted or replaced word."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    k = 0
    while k < len(a) and a[k] == b[k]:
        k += 1
    return a[k + (len(a) == len(b)) :] == b[k + 1 :]


def _verify(batches):
    for batch in batches:
        keep = [within_one_edit(x.lower().split(), y.lower().split()) for x, y in
                zip(batch.column("text").to_pylist(), batch.column("other").to_pylist(), strict=True)]
        yield batch.select(["block", "line"]).filter(pa.array(keep, type=pa.bool_()))


def line_dedup(spark: SparkSession, docs: DataFrame, min_words: int = 1, near_words: int = 5,
               id_col: str = "doc_id", text_col: str = "text",
               scratch: Scratch | None = None) -> DataFrame:
    """The documents without the lines that an earlier line makes redundant.

    Lines are the parts of a text between line feeds; their words are ``[^\\x20\\x09-\\x0D]+`` after
    A-Z is lower-cased.  A line of ``min_words`` words or more is dropped if the same words make up
    an earlier line, in order of document id and place.  A line of ``near_words`` or more is also
    dropped if an earlier line, of at least ``near_words`` too, is one word edit away.  Lines are
    judged on the input: a dropped line still counts as earlier.  Shorter and blank lines stay.

    Null texts stay null, empty ones empty.  Of rows with equal ids, the order of the block table
    decides for equal lines, and near lines of two such rows both stay; a null id counts as the
    largest.  An empty table gives no rows.

    Returns all columns of ``docs``, the text rewritten, and n_lines, n_copies (dropped as equal),
    n_near (dropped as near), kept_sha256 (hex digest of the text left; null text: of nothing) in a
    struct column ``line_dedup`` (a column of that name is replaced).  ``scratch`` takes the
    intermediate tables, for the caller to drop once the result is written.
    """
    scratch = scratch or Scratch(spark, "lines")
    docs = docs.drop("line_dedup")
    blocks = Blocks(spark, docs.withColumn(id_col, F.col(id_col).cast("bigint")), BLOCK_BYTES,
                    id_col, text_col, carry=True, scratch=scratch)
    known: dict[str, DataFrame] = {}

    def first(block: Block, _: dict):
        return Lines(block, min_words, near_words).first_keys()[:3]

    known["first"] = answer(blocks.ask(first, blocks.buckets(0.012)), _decide_first, "u8", "u8",
                            _MARK, name="lines", write=scratch.write)

    def second(block: Block, known: dict):
        lines = Lines(block, min_words, near_words)
        lines.after_first(known)
        return lines.second_keys()[:3]

    known["second"] = answer(blocks.ask(second, blocks.buckets(0.03), dict(known)),
                             _decide_second, "u8", "u1", name="variants", write=scratch.write)
    shared_schema = pa.schema([
        ("key", pa.int64()), ("role", pa.int32()), ("block", pa.int64()), ("line", pa.int32()),
        ("id", pa.int64()), ("place", pa.int64()), ("text", pa.binary())])

    def sharing(block: Block, known: dict) -> list[pa.RecordBatch]:
        """A row a key and line, without text, and a row a line with its text, without key."""
        lines = Lines(block, min_words, near_words)
        lines.after_first(known)
        distinct, role, _, of, keys, line = lines.second_keys()
        hit = np.flatnonzero(said(known, "second", len(distinct))[of] > 0)
        hit = hit[np.unique(np.stack([of[hit], line[hit]]), axis=1, return_index=True)[1]]
        line, shown = line[hit], np.unique(line[hit])
        n, m = len(line), len(shown)
        every = np.concatenate([line, shown])
        texts = [block.data[s:e].tobytes() for s, e in zip(lines.start[shown], lines.end[shown], strict=True)]
        return [pa.RecordBatch.from_arrays([
            pa.concat_arrays([pa.array(keys[hit].view(np.int64)), pa.nulls(m, pa.int64())]),
            pa.concat_arrays([pa.array(role[of[hit]].astype(np.int32)), pa.nulls(m, pa.int32())]),
            pa.array(np.full(n + m, block.block, dtype=np.int64)),
            pa.array(every.astype(np.int32)), pa.array(lines.id[every]),
            pa.array(lines.start[every] - block.starts[lines.doc[every]]),
            pa.concat_arrays([pa.nulls(n, pa.binary()), pa.array(texts, type=pa.binary())])],
            schema=shared_schema)]

    found = scratch.write(blocks.visit(
        sharing, "key long, role int, block long, line int, id long, place long, text binary",
        shared_schema, dict(known)), "shared_lines")
    shared = found.filter("key IS NOT NULL").drop("text")
    texts = found.filter("key IS NULL").select("block", "line", "text")
    first_of = shared.groupBy("key", "role").agg(
        F.min(F.struct("id", "place", "block", "line")).alias("first"))
    # a place meets a place, a whole line a deletion
    first_of = first_of.select(
        "key", F.when(F.col("role") == PLACE, PLACE).otherwise(1 - F.col("role")).alias("role"),
        F.col("first.id").alias("first_id"), F.col("first.place").alias("first_place"),
        F.col("first.block").alias("first_block"), F.col("first.line").alias("first_line"))
    pairs = (shared.join(first_of, ["key", "role"])
             .filter((F.col("first_id") < F.col("id"))
                     | ((F.col("first_id") == F.col("id")) & (F.col("first_block") == F.col("block"))
                        & (F.col("first_place") < F.col("place"))))
             .select("block", "line", "first_block", "first_line").distinct())
    others = texts.select(F.col("block").alias("first_block"), F.col("line").alias("first_line"),
                          F.col("text").alias("other"))
    pairs = pairs.join(texts, ["block", "line"]).join(others, ["first_block", "first_line"])
    near = scratch.write(pairs.select("block", "line", "text", "other").mapInArrow(
        _verify, "block long, line int").distinct(), "near_lines")
    known["near"] = near.select("block", F.col("line").alias("bucket"),
                                F.lit(b"").alias("bits"))
    del known["second"]
    extra = blocks.table.schema["extra"].dataType.elementType
    schema = (f"extra {extra.simpleString()}, text binary, n_lines long, n_copies long, "
              "n_near long, kept_sha256 string")

    def finish(block: Block, known: dict) -> list[pa.RecordBatch]:
        lines = Lines(block, min_words, near_words)
        lines.after_first(known)
        n = len(block.ids)
        near = np.fromiter(known.get("near", {}), dtype=np.int64)
        gone = np.zeros(len(lines.n), dtype=bool)
        gone[lines.copies] = True
        gone[near] = True
        byte = np.repeat(~gone, lines.end - lines.start + 1)
        texts = []
        touched = np.bincount(lines.doc[gone], minlength=n) > 0
        for s, e, cut in zip(block.starts, block.ends, touched, strict=True):
            part = block.data[s:e + 1]
            texts.append(part[byte[s:e + 1]].tobytes()[:-1] if cut else part[:-1].tobytes())
        shown = [None if null else t for t, null in zip(texts, block.null, strict=True)]
        return [pa.RecordBatch.from_arrays([
            block.extra, pa.array(shown, type=pa.binary()),
            pa.array(np.bincount(lines.doc, minlength=n).astype(np.int64)),
            pa.array(np.bincount(lines.doc[lines.copies], minlength=n).astype(np.int64)),
            pa.array(np.bincount(lines.doc[near], minlength=n).astype(np.int64)),
            pa.array([hashlib.sha256(t).hexdigest() for t in texts])],
            names=["extra", *_FINISHED.names])]

    def finished(table: pa.Schema) -> pa.Schema:
        return _FINISHED.insert(0, pa.field("extra", table.field("extra").type.value_type))

    out = blocks.visit(finish, schema, finished, known)
    stats = F.struct("n_lines", "n_copies", "n_near", "kept_sha256")
    return out.select(*[F.col(f"extra.`{c}`").alias(c) if c != text_col else
                        F.col("text").cast("string").alias(c) for c in docs.columns],
                      stats.alias("line_dedup"))
