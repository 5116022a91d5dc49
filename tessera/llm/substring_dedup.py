"""Substring dedup: remove word sequences of threshold length that occurred earlier.

Method: level-wise doubling.  Lengths run 5, 10, 20 for a threshold of 20.  Windows that repeat at
one length alone are extended to twice that length; a window of 2m words is a candidate only if
both its halves repeat.  The last level also learns which occurrence is the earliest.

The base level asks for one window in a few: of the base-length windows inside a full-length one,
the one with the least hash.  Equal full-length windows have equal least base windows, so a full
window whose least base window does not repeat cannot repeat: nothing is lost.

Keys travel by the block exchange (``blocks.py``): a window found in n copies costs a key a block,
and no level forms pairs.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tessera.llm.blocks import Block, Blocks, answer, groups, said
from tessera.llm.hashing import join_hashes, mix, sliding, span_hashes, windows_of, word_spans

BLOCK_BYTES = 2 << 20
#: The base level is at most this long.
BASE_WORDS = 5
RESULT = ("doc_id long, n_words long, n_removed long, kept_sha256 string, "
          "removed array<struct<start:long,end:long>>")
_RESULT_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
    ("kept_sha256", pa.string()),
    ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])
REPEATED = EARLIER = 1


def levels(threshold: int) -> list[int]:
    """Window lengths, each at most twice the one before; the last is the threshold."""
    out = [threshold]
    while out[0] > BASE_WORDS:
        out.insert(0, -(-out[0] // 2))
    return out


class _Words:
    """The words of a block and the candidates among its full-length windows."""

    def __init__(self, block: Block, threshold: int):
        self.block, self.lengths = block, levels(threshold)
        starts, ends = word_spans(block.data)
        self.doc = np.searchsorted(block.starts, starts, side="right") - 1
        self.hash = {1: span_hashes(block.data, starts, ends)}
        base = self.lengths[0]
        self.hash[base] = windows_of(self.hash[1], base)
        for half, full in zip(self.lengths[:-1], self.lengths[1:], strict=True):
            h = self.hash[half]
            n = max(0, len(starts) - full + 1)
            self.hash[full] = join_hashes(h[:n], h[full - half : full - half + n])
        n = max(0, len(starts) - threshold + 1)
        self.inside = self.doc[:n] == self.doc[threshold - 1 :][:n] if n else np.zeros(0, bool)
        self.width = threshold - base + 1
        self.least = sliding(np.minimum, self.hash[base], self.width) if n else np.zeros(
            0, np.uint64)

    def base_keys(self) -> tuple[np.ndarray, None, np.ndarray]:
        """Distinct least base windows; the mark says that one is at several places."""
        base = self.hash[self.lengths[0]]
        if not len(self.least):
            return np.empty(0, np.uint64), None, np.empty(0, np.uint8)
        held = np.where(self.inside, self.least, np.uint64(0))
        pad = np.zeros(self.width - 1, dtype=np.uint64)
        chosen = base == sliding(np.maximum, np.concatenate([pad, held, pad]), self.width)
        keys, count = np.unique(mix(base[chosen]), return_counts=True)
        return keys, None, (count > 1).astype(np.uint8)

    def after_base(self, known: dict) -> np.ndarray:
        """Full-length windows whose least base window repeats."""
        keys, _, _ = self.base_keys()
        repeated = keys[said(known, f"level{self.lengths[0]}", len(keys)) == REPEATED]
        at = np.flatnonzero(self.inside)
        mine = mix(self.least[at])
        place = np.searchsorted(repeated, mine)
        hit = place < len(repeated)
        hit[hit] = repeated[place[hit]] == mine[hit]
        return at[hit]

    def pieces(self, windows: np.ndarray, length: int) -> np.ndarray:
        """Starts of the ``length``-word windows that tile the candidate full windows."""
        full = self.lengths[-1]
        wanted = np.zeros(len(self.doc) + 1, dtype=bool)
        for off in self.offsets(length, full):
            wanted[windows + off] = True
        return np.flatnonzero(wanted)

    @staticmethod
    def offsets(length: int, full: int) -> list[int]:
        return sorted({*range(0, full - length, length), full - length})

    def keys_at(self, length: int, at: np.ndarray):
        keys = self.hash[length][at]
        distinct, of, count = np.unique(keys, return_inverse=True, return_counts=True)
        return distinct, (count > 1).astype(np.uint8), of

    def candidates(self, known: dict, upto: int) -> np.ndarray:
        """Full-length windows all of whose pieces repeat at every level below ``upto``."""
        windows = self.after_base(known)
        full = self.lengths[-1]
        for length in self.lengths[1:-1]:
            if length >= upto:
                break
            at = self.pieces(windows, length)
            keys, _, of = self.keys_at(length, at)
            repeated = np.zeros(len(self.doc) + 1, dtype=bool)
            repeated[at] = said(known, f"level{length}", len(keys))[of] == REPEATED
            keep = np.ones(len(windows), dtype=bool)
            for off in self.offsets(length, full):
                keep &= repeated[windows + off]
            windows = windows[keep]
        return windows

    def full_keys(self, windows: np.ndarray):
        """Candidates in order of key and then place; starts of the runs of equal ones."""
        ids = np.array([np.iinfo(np.int64).max if i is None else i for i in self.block.ids],
                       dtype=np.int64)
        rank = np.empty(len(ids), dtype=np.int64)
        rank[np.argsort(ids, kind="stable")] = np.arange(len(ids))
        doc = self.doc[windows]
        windows = windows[np.lexsort((windows, rank[doc]))]
        keys = self.hash[self.lengths[-1]][windows]
        more = (mix(self.least[windows]) >> np.uint64(32)).astype(np.uint32)
        order, starts = groups(keys, more)
        first = order[starts]
        return windows[order], starts, keys[first], more[first], ids[self.doc[windows[first]]]

    def removed(self, known: dict) -> np.ndarray:
        windows = self.candidates(known, self.lengths[-1])
        ordered, starts, keys, _, _ = self.full_keys(windows)
        gone = np.ones(len(ordered), dtype=bool)
        gone[starts] = said(known, "full", len(keys)) == EARLIER
        edge = np.zeros(len(self.doc) + 1, dtype=np.int32)
        np.add.at(edge, ordered[gone], 1)
        np.add.at(edge, ordered[gone] + self.lengths[-1], -1)
        return np.cumsum(edge[:-1]) > 0


def _decide_repeated(keys, more, marks, row):
    order, starts = groups(keys)
    ends = np.append(starts[1:], len(keys))
    out = np.empty(len(keys), dtype=np.uint8)
    out[order] = np.repeat((ends - starts > 1) | (np.maximum.reduceat(marks[order], starts) > 0),
                           ends - starts)
    return out


def _decide_earlier(keys, more, marks, row):
    """EARLIER unless the entry has the smallest doc_id of its key (ties: the smallest block)."""
    by_doc = np.argsort(marks, kind="stable")
    order, starts = groups(keys[by_doc], more[by_doc])
    out = np.full(len(keys), EARLIER, dtype=np.uint8)
    out[by_doc[order[starts]]] = 0
    return out


def substring_dedup(spark: SparkSession, docs: DataFrame, threshold: int = 20,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: what is left when each word covered by a repeated window is removed.

    ``docs`` needs an integer id and a text; other columns are ignored.  Words are
    ``[^\\x20\\x09-\\x0D]+``, unchanged.  A window is ``threshold`` consecutive words of one document;
    it is removed if the same words also start earlier: in a document of smaller id, or earlier in
    the same one.  Windows are judged on the input.

    Null and empty texts have no words.  Of rows with the same id the order is that of the block
    table (one of them counts as earlier); a null id counts as the largest.  An empty table gives
    no rows.

    Returns doc_id, n_words, n_removed, kept_sha256 (kept words joined by one space, UTF-8, hex)
    and removed (array of [start, end) word positions).
    """
    blocks = Blocks(spark, docs, BLOCK_BYTES, id_col, text_col)
    lengths = levels(threshold)
    known: dict[str, DataFrame] = {}

    def base(block: Block, _: dict):
        return _Words(block, threshold).base_keys()

    known[f"level{lengths[0]}"] = answer(
        blocks.ask(base, blocks.buckets(0.02)), _decide_repeated, "u8", None, name="base")

    def longer(length: int):
        def emit(block: Block, known: dict):
            w = _Words(block, threshold)
            keys, marks, _ = w.keys_at(length, w.pieces(w.candidates(known, length), length))
            return keys, None, marks
        return emit

    for length in lengths[1:-1]:
        known[f"level{length}"] = answer(
            blocks.ask(longer(length), blocks.buckets(0.05), dict(known)), _decide_repeated, "u8",
            None, name=f"level{length}")

    def full(block: Block, known: dict):
        w = _Words(block, threshold)
        _, _, keys, more, ids = w.full_keys(w.candidates(known, threshold))
        return keys, more, ids

    known["full"] = answer(blocks.ask(full, blocks.buckets(0.05), dict(known)), _decide_earlier,
                           "u8", "u4", "i8", name="full")

    def finish(block: Block, known: dict) -> list[pa.RecordBatch]:
        w = _Words(block, threshold)
        return [_result(block, w.doc, w.removed(known))]

    return blocks.visit(finish, RESULT, _RESULT_ARROW, known)


def _result(block: Block, doc: np.ndarray, gone: np.ndarray) -> pa.RecordBatch:
    cuts = np.searchsorted(doc, np.arange(len(block.ids) + 1))
    rows = []
    for k, (doc_id, s, e) in enumerate(zip(block.ids, block.starts, block.ends, strict=True)):
        words = block.data[s:e].tobytes().split()
        mine = gone[cuts[k] : cuts[k + 1]]
        n = int(np.count_nonzero(mine))
        spans = []
        if n:
            edge = np.flatnonzero(np.diff(np.concatenate([[False], mine, [False]]).view(np.int8)))
            spans = [{"start": int(a), "end": int(b)}
                     for a, b in zip(edge[0::2], edge[1::2], strict=True)]
            words = compress(words, (~mine).tolist())
        rows.append((doc_id, len(mine), n, hashlib.sha256(b" ".join(words)).hexdigest(), spans))
    cols = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in
                                       zip(cols, _RESULT_ARROW, strict=True)],
                                      schema=_RESULT_ARROW)
