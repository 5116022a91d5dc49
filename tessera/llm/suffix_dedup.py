"""Suffix-array dedup: remove every byte string of threshold length that also starts elsewhere.

Method: depth-limited radix sort.  Suffixes are ordered only through the first ``threshold`` bytes,
by most-significant-digit passes; a pass splits the groups of the last one by a further digit, and
a suffix alone in its group leaves the sort.  Equal groups at full depth are the repeated windows.

Digits are hashes, so a group is an equality class and needs no order within.  The passes:

1. *digit 1* of the suffix at p is the least hash among the ``GRAM``-byte strings inside
   ``[p, p + threshold)``.  Equal windows have equal digits, and neighbouring suffixes mostly share
   theirs, so a whole run of suffixes (a *region*) is dealt as one key.  Groups of one leave.
2. *digit 2* is the region's bytes.  A region that repeats whole is a set of repeated windows; one
   region of each such class stands for it below, all others of the class are done.
3. *full depth*: the windows of the regions still open, each as a key.

A group of n copies costs n keys in passes 1 and 2 and one region in pass 3, never pairs.  Keys are
96 bits or more (window hash and digit 1), so false equality is out of reach at any corpus size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tessera.llm.blocks import Block, Blocks, answer, groups, said
from tessera.llm.hashing import Prefix, join_hashes, mix, slices, sliding

#: Bytes of text in a block, and suffixes that are hashed in one go.
BLOCK_BYTES = 2 << 20
STEP = 1 << 19
SHARED, MIXED = 1, 2  # answers of pass 1
REPEATED, STANDS = 1, 2  # answers of pass 2

RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
_RESULT_ARROW = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()),
                           ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                           ("kept_sha256", pa.string())])


@dataclass
class Regions:
    """Runs of suffixes of a block that share digit 1."""

    start: np.ndarray   # first suffix
    count: np.ndarray   # suffixes
    digit: np.ndarray   # digit 1
    content: np.ndarray  # hash of all bytes of the region
    several: np.ndarray  # whether digit 1 occurs at more than one place inside


class Windows:
    """All windows of ``threshold`` bytes of a block, slice by slice."""

    def __init__(self, block: Block, threshold: int):
        self.block, self.threshold = block, threshold
        self.gram = max(1, threshold // 4)
        self.width = threshold - self.gram + 1
        data = block.data
        # a suffix has a window if its document goes on for threshold bytes
        self.open = np.zeros(len(data), dtype=bool)
        for s, e in zip(block.starts, block.ends, strict=True):
            if e - s >= threshold:
                self.open[s : e - threshold + 1] = True

    def parts(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(first suffix, digit 1, window hash, hash of the gram at the suffix)."""
        t, data = self.threshold, self.block.data
        for a, b in slices(max(0, len(data) - t + 1), STEP):
            prefix = Prefix(data[a : min(len(data), b + t - 1)], STEP + t + 1)
            window = prefix.window(t)
            gram = prefix.window(self.gram)
            digit = sliding(np.minimum, gram, self.width)
            yield a, digit[: b - a], window[: b - a], gram[: b - a + self.width - 1]

    def regions(self) -> Regions:
        found = [([], [], [], [], [])]
        for a, digit, window, gram in self.parts():
            open_ = self.open[a : a + len(digit)]
            if not open_.any():
                continue
            change = np.ones(len(digit), dtype=bool)
            change[1:] = (digit[1:] != digit[:-1]) | (open_[1:] != open_[:-1])
            first = np.flatnonzero(change)
            count = np.diff(np.append(first, len(digit)))
            # regions over 2 * threshold bytes (periodic text) are cut: their first and last
            # windows must cover them
            if count.max(initial=0) > self.threshold:
                pieces = -(-count // self.threshold)
                base = np.repeat(first, pieces)
                nth = np.arange(len(base)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                left = np.repeat(count, pieces) - nth * self.threshold
                first, count = base + nth * self.threshold, np.minimum(left, self.threshold)
            keep = open_[first]
            first, count = first[keep], count[keep]
            last = first + count - 1
            content = mix(join_hashes(window[first], window[last]) + count.astype(np.uint64))
            # how often digit 1 occurs as a gram inside a region
            own = digit[first]
            reach = last + self.width
            where = np.flatnonzero(self._is_digit(gram, digit, open_))
            lo, hi = np.searchsorted(where, first), np.searchsorted(where, reach)
            several = np.zeros(len(first), dtype=bool)
            many = np.flatnonzero(hi - lo > 1)
            several[many] = [np.count_nonzero(gram[where[x:y]] == v) > 1
                             for x, y, v in zip(lo[many], hi[many], own[many], strict=True)]
            # a least hash is small: spread it again, or low buckets would get nearly all keys
            found.append((first + a, count, mix(own), content, several))
        kinds = (np.int64, np.int64, np.uint64, np.uint64, bool)
        return Regions(*[np.concatenate([np.asarray(f[k], dtype=kinds[k]) for f in found])
                         for k in range(5)])

    def _is_digit(self, gram: np.ndarray, digit: np.ndarray, open_: np.ndarray) -> np.ndarray:
        """Positions whose gram is digit 1 of some suffix that covers them."""
        held = np.where(open_, digit, np.uint64(0))
        pad = np.zeros(self.width - 1, dtype=np.uint64)
        return gram == sliding(np.maximum, np.concatenate([pad, held, pad]), self.width)

    def hashes_at(self, wanted: np.ndarray) -> np.ndarray:
        """Window hashes of the suffixes marked in ``wanted``, in their order."""
        out = [np.empty(0, dtype=np.uint64)]
        for a, b in slices(max(0, len(self.block.data) - self.threshold + 1), STEP):
            at = np.flatnonzero(wanted[a:b])
            if len(at):
                prefix = Prefix(self.block.data[a : b + self.threshold - 1],
                                STEP + self.threshold + 1)
                out.append(prefix.spans(at, at + self.threshold))
        return np.concatenate(out)


def _marked(n: int, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Mask of the items covered by the ranges."""
    edge = np.zeros(n + 1, dtype=np.int32)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + count, -1)
    return np.cumsum(edge[:-1]) > 0


# pass 1 ------------------------------------------------------------------------------------------
def _digits(r: Regions) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct digits of a block, a region's content for each, marks, and each region's digit."""
    if not len(r.digit):
        none = np.empty(0, dtype=np.uint64)
        return none, none, np.empty(0, dtype=np.uint8), np.empty(0, dtype=np.int64)
    order = np.lexsort((r.content, r.digit))
    digit, content = r.digit[order], r.content[order]
    starts = np.flatnonzero(np.concatenate([[True], digit[1:] != digit[:-1]]))
    ends = np.append(starts[1:], len(digit))
    several = np.maximum.reduceat(r.several[order].astype(np.uint8), starts).astype(bool)
    mixed = several | (content[starts] != content[ends - 1])
    marks = ((several | (ends - starts > 1)) * SHARED + mixed * MIXED).astype(np.uint8)
    of = np.empty(len(digit), dtype=np.int64)
    of[order] = np.repeat(np.arange(len(starts)), ends - starts)
    return digit[starts], content[starts], marks, of


def _decide_digit(keys, more, marks, row):
    order, starts = groups(keys)
    ends = np.append(starts[1:], len(keys))
    m = marks[order]
    content = more[order]
    shared = (ends - starts > 1) | (np.bitwise_or.reduceat(m, starts) & SHARED > 0)
    mixed = ((np.minimum.reduceat(content, starts) != np.maximum.reduceat(content, starts))
             | (np.bitwise_or.reduceat(m, starts) & MIXED > 0))
    out = np.empty(len(keys), dtype=np.uint8)
    out[order] = np.repeat(shared * SHARED + mixed * MIXED, ends - starts)
    return out


# pass 2 ------------------------------------------------------------------------------------------
def _contents(r: Regions, pick: np.ndarray):
    """Distinct (content, digit) of the picked regions, and for each picked region its number."""
    keys, more = r.content[pick], (r.digit[pick] >> np.uint64(32)).astype(np.uint32)
    order, starts = groups(keys, more)
    ends = np.append(starts[1:], len(keys))
    of = np.empty(len(keys), dtype=np.int64)
    of[order] = np.repeat(np.arange(len(starts)), ends - starts)
    return keys[order][starts], more[order][starts], (ends - starts > 1).astype(np.uint8), of


def _decide_repeated(keys, more, marks, row):
    """REPEATED if more than one row has the key or one row has it more than once; the key's
    first row also STANDS for it."""
    order, starts = groups(keys, more)
    ends = np.append(starts[1:], len(keys))
    repeated = (ends - starts > 1) | (np.maximum.reduceat(marks[order], starts) > 0)
    flags = np.repeat(repeated * REPEATED, ends - starts)
    flags[starts] |= STANDS
    out = np.empty(len(keys), dtype=np.uint8)
    out[order] = flags
    return out


class _Sort:
    """What a block knows after each pass."""

    def __init__(self, block: Block, threshold: int):
        self.windows = Windows(block, threshold)
        self.regions = self.windows.regions()

    def after_1(self, known: dict) -> None:
        digit, _, _, of = _digits(self.regions)
        got = said(known, "digit", len(digit))[of] if len(of) else np.empty(0, dtype=np.uint8)
        self.whole = (got & SHARED > 0) & (got & MIXED == 0)
        self.open = (got & SHARED > 0) & (got & MIXED > 0)

    def after_2(self, known: dict) -> None:
        pick = np.flatnonzero(self.open)
        key, _, _, of = _contents(self.regions, pick)
        got = said(known, "region", len(key))[of] if len(pick) else np.empty(0, dtype=np.uint8)
        repeated = got & REPEATED > 0
        first = np.zeros(len(pick), dtype=bool)
        first[np.unique(of, return_index=True)[1]] = True
        self.whole[pick[repeated]] = True
        self.deal = pick[~repeated | (first & (got & STANDS > 0))]

    def dealt(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Suffixes dealt at full depth, their window hashes and digits."""
        r, at = self.regions, np.sort(self.deal)
        n = len(self.windows.block.data)
        wanted = _marked(n, r.start[at], r.count[at])
        digits = (np.repeat(r.digit[at], r.count[at]) >> np.uint64(32)).astype(np.uint32)
        return np.flatnonzero(wanted), self.windows.hashes_at(wanted), digits

    def removed(self, known: dict) -> np.ndarray:
        n, t = len(self.windows.block.data), self.windows.threshold
        r = self.regions
        repeated = _marked(n, r.start[self.whole], r.count[self.whole])
        at, keys, more = self.dealt()
        order, starts = groups(keys, more)
        if len(keys):
            got = np.empty(len(keys), dtype=np.uint8)
            got[order] = np.repeat(said(known, "window", len(starts)),
                                   np.diff(np.append(starts, len(keys))))
            repeated[at[got & REPEATED > 0]] = True
        runs = np.flatnonzero(repeated)
        return _marked(n, runs, np.full(len(runs), t))


def suffix_dedup(spark: SparkSession, docs: DataFrame, threshold: int = 200,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: what is left when each byte covered by a repeated window is removed.

    ``docs`` needs an integer id and a text; other columns are ignored.  A window is ``threshold``
    consecutive bytes (UTF-8) of one document; it is repeated if it also starts anywhere else, in
    the same document included, overlaps counted.  Windows are judged on the input.

    Null text counts as empty.  A text under ``threshold`` bytes loses nothing.  Rows with equal or
    null ids are documents of their own and come back as such.  An empty table gives no rows.

    Returns doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 (hex digest of
    the remaining bytes), removed (array of [start, end) byte offsets).
    """
    blocks = Blocks(spark, docs, BLOCK_BYTES, id_col, text_col)

    def digits(block: Block, known: dict):
        return _digits(_Sort(block, threshold).regions)[:3]

    def contents(block: Block, known: dict):
        s = _Sort(block, threshold)
        s.after_1(known)
        return _contents(s.regions, np.flatnonzero(s.open))[:3]

    def windows(block: Block, known: dict):
        s = _Sort(block, threshold)
        s.after_1(known)
        s.after_2(known)
        _, keys, more = s.dealt()
        order, starts = groups(keys, more)
        count = np.diff(np.append(starts, len(keys)))
        return keys[order][starts], more[order][starts], (count > 1).astype(np.uint8)

    known: dict[str, DataFrame] = {}
    # about two regions in threshold - gram suffixes
    share = 2.0 / max(1, threshold - threshold // 4)
    known["digit"] = answer(blocks.ask(digits, blocks.buckets(share)), _decide_digit,
                            "u8", "u8", name="digit")
    known["region"] = answer(blocks.ask(contents, blocks.buckets(share / 4), known),
                             _decide_repeated, "u8", "u4", name="region")
    known["window"] = answer(blocks.ask(windows, blocks.buckets(0.1), known),
                             _decide_repeated, "u8", "u4", name="window")

    def finish(block: Block, known: dict) -> list[pa.RecordBatch]:
        s = _Sort(block, threshold)
        s.after_1(known)
        s.after_2(known)
        return [_result(block, s.removed(known))]

    return blocks.visit(finish, RESULT + ", removed array<struct<start:long,end:long>>",
                        _result_schema(), known)


def _result_schema() -> pa.Schema:
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    return _RESULT_ARROW.append(pa.field("removed", pa.list_(span)))


def _result(block: Block, gone: np.ndarray) -> pa.RecordBatch:
    rows = []
    for doc_id, s, e in zip(block.ids, block.starts, block.ends, strict=True):
        cut = gone[s:e]
        text = block.data[s:e]
        n = int(np.count_nonzero(cut))
        if n:
            edge = np.flatnonzero(np.diff(np.concatenate([[False], cut, [False]]).view(np.int8)))
            spans = [{"start": int(a), "end": int(b)}
                     for a, b in zip(edge[0::2], edge[1::2], strict=True)]
            text = text[~cut]
        else:
            spans = []
        rows.append((doc_id, int(e - s), n, len(spans),
                     hashlib.sha256(text.tobytes()).hexdigest(), spans))
    schema = _result_schema()
    cols = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type)
                                       for c, f in zip(cols, schema, strict=True)], schema=schema)
