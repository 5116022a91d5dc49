"""Periodic runs of words: maximal repetitions found from Lyndon roots and suffix-tree LCE.

A run is a stretch of words with smallest period q, at least twice as long as q, that no neighbour
extends.  By the runs theorem every run holds a longest Lyndon word of length q at some position,
under the order of words or under its reverse.  So, for a stretch of n words:

1. Ukkonen's algorithm builds the suffix trees of the stretch and of its reversal;
2. an Euler tour of a tree, children in order, gives the ranks of the suffixes; of the tour, the
   least depth between neighbouring leaves is kept, and a sparse table over it answers the depth of
   two leaves' lowest common ancestor, that is their longest common extension, in constant time;
3. the longest Lyndon word at i ends before the next smaller suffix (the next greater one for the
   reversed order): two candidate roots a position;
4. a candidate (i, q) extends to the right as far as the suffixes of i and i+q agree and to the left
   as far as the reversal's suffixes do; it is a run if it is long enough.

Only words that can lie in a run get there: a run of at least 12 words and two periods repeats each
window of ``WINDOW`` words of it (below), so its words all lie in windows that occur twice in the
text.  The stretches of such words are searched; what lies between them belongs to no run.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import ship
from tessera.llm.hashing import join_hashes, mix, span_hashes, windows_of
from tessera.llm.texts import Texts, chunks

SHORTEST = 12

_OUT = ("id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
        "runs_sha256 string, collapsed_sha256 string, "
        "runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed binary")
_NAMES = ["id", "n_words", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
          "collapsed_sha256", "runs", "collapsed"]
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def suffix_tree(s: list[int], sigma: int) -> tuple[dict[int, int], list[int], list[int]]:
    """Ukkonen's tree of ``s``, whose last symbol occurs once; symbols are below ``sigma``.

    Returns the edges (node * sigma + first symbol -> child), the start of each node's edge in
    ``s`` and its end (-1: a leaf, whose edge runs to the end).  Leaves are made in the order of
    their suffixes; the root is 0."""
    edges: dict[int, int] = {}
    start, end, link = [0], [0], [0]
    node, edge, length, left = 0, 0, 0, 0
    for i, c in enumerate(s):
        left += 1
        waits = 0
        while left:
            if not length:
                edge = i
            key = node * sigma + s[edge]
            child = edges.get(key)
            if child is None:
                edges[key] = len(start)
                start.append(i)
                end.append(-1)
                link.append(0)
                if waits:
                    link[waits] = node
                waits = 0
            else:
                first, to = start[child], end[child]
                size = (i + 1 if to < 0 else to) - first
                if length >= size:  # walk down
                    edge += size
                    length -= size
                    node = child
                    continue
                if s[first + length] == c:
                    length += 1
                    if waits:
                        link[waits] = node
                    break
                middle = len(start)  # split the edge
                start += (first, i)
                end += (first + length, -1)
                link += (0, 0)
                edges[key] = middle
                edges[middle * sigma + c] = middle + 1
                start[child] = first + length
                edges[middle * sigma + s[first + length]] = child
                if waits:
                    link[waits] = middle
                waits = middle
            left -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - left + 1
    return edges, start, end


class Extensions:
    """Ranks of the suffixes of ``s`` (symbols from 0 below ``sigma``) and their longest common
    extensions."""

    def __init__(self, s: list[int], sigma: int):
        n = len(s)
        closed = [c + 1 for c in s] + [0]
        edges, start, end = suffix_tree(closed, sigma + 1)
        keys = np.fromiter(edges.keys(), dtype=np.int64, count=len(edges))
        order = np.argsort(keys)
        to = np.fromiter(edges.values(), dtype=np.int64, count=len(edges))[order]
        at = np.searchsorted(keys[order], np.arange(len(start) + 1, dtype=np.int64) * (sigma + 1)).tolist()
        # with the deepest edge on top: reversed children, the first child last
        to = to.tolist()
        del edges, keys, order
        leaves, lows = [], []
        stack = [(0, 0, 0)]  # node, depth at its parent, least depth of the tour since the last leaf
        while stack:
            node, depth, low = stack.pop()
            if end[node] < 0:
                # the suffix of a leaf begins its depth before the leaf's edge does
                leaves.append(start[node] - depth)
                lows.append(low)
                continue
            depth += end[node] - start[node]
            first, last = at[node], at[node + 1]
            stack += [(to[k], depth, depth) for k in range(last - 1, first, -1)]
            stack.append((to[first], depth, low))
        suffixes = np.array(leaves[1:], dtype=np.int64)  # the first is the closing symbol's
        self.n = n
        self.rank = np.empty(n + 1, dtype=np.int64)
        self.rank[suffixes] = np.arange(n)
        self.rank[n] = -1
        # table[k][r]: least depth of the tour between the leaves of ranks r and r + 2**k
        least = np.array(lows[2:], dtype=np.int32)
        self._table = [least]
        while (1 << len(self._table)) <= len(least):
            half = 1 << (len(self._table) - 1)
            prev = self._table[-1]
            self._table.append(np.minimum(prev[:-half], prev[half:]))

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Longest common extension of positions a and b (different; ``n`` has none)."""
        out = np.zeros(len(a), dtype=np.int64)
        inside = np.flatnonzero((a < self.n) & (b < self.n))
        ra, rb = self.rank[a[inside]], self.rank[b[inside]]
        lo, width = np.minimum(ra, rb), np.abs(ra - rb)
        level = np.frexp(width.astype(np.float64))[1] - 1
        for k in np.unique(level):
            of = np.flatnonzero(level == k)
            row = self._table[k]
            out[inside[of]] = np.minimum(row[lo[of]], row[lo[of] + width[of] - (1 << int(k))])
        return out


def lyndon_roots(rank: list[int]) -> tuple[list[int], list[int]]:
    """(positions, lengths) of the longest Lyndon words that start at each position, for the order
    behind ``rank`` and for its reverse (there, one without a next greater suffix is left out)."""
    n = len(rank)
    at, size, smaller, greater = [], [], [], []
    for j, r in enumerate(rank):
        while smaller and rank[smaller[-1]] > r:
            i = smaller.pop()
            at.append(i)
            size.append(j - i)
        smaller.append(j)
        while greater and rank[greater[-1]] < r:
            i = greater.pop()
            at.append(i)
            size.append(j - i)
        greater.append(j)
    at += smaller
    size += [n - i for i in smaller]
    return at, size


def runs_of(s: list[int], sigma: int, shortest: int = SHORTEST) -> np.ndarray:
    """Rows (start, length, period) of the runs of a sequence, each once."""
    n = len(s)
    if n < shortest:
        return np.empty((0, 3), dtype=np.int64)
    ahead = Extensions(s, sigma)
    at, size = (np.array(x, dtype=np.int64) for x in lyndon_roots(ahead.rank[:n].tolist()))
    fits = 2 * size <= n
    at, size = at[fits], size[fits]
    right = ahead.common(at, at + size)
    del ahead
    back = Extensions(s[::-1], sigma)
    # from i - 1 and i + q - 1 backwards; position 0 has nothing before it
    left = back.common(np.where(at > 0, n - at, n), n - at - size)
    rows = np.stack([at - left, left + size + right, size], axis=1)
    rows = rows[(rows[:, 1] >= 2 * size) & (rows[:, 1] >= shortest)]
    return np.unique(rows, axis=0)


def _folded(doc_id: int | None, n: int) -> np.ndarray | None:
    """Which original word stands at each place, of documents that are made periodic."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    out = np.arange(n)
    out[a:] = a + (out[a:] - a) % p
    return out


def _covered(hashes: np.ndarray, doc: np.ndarray, window: int) -> np.ndarray:
    """Words that lie in a window that occurs twice or more in the same document."""
    covered = np.zeros(len(hashes) + 1, dtype=np.int32)
    if len(hashes) >= window:
        last = len(hashes) - window + 1
        inside = np.flatnonzero(doc[:last] == doc[window - 1 :])
        keys = join_hashes(mix(doc.astype(np.uint64)), hashes)
        keys = windows_of(keys, window)[inside]
        order = np.argsort(keys)
        k = keys[order]
        twin = np.zeros(len(k) + 1, dtype=bool)
        twin[1:-1] = k[1:] == k[:-1]
        again = inside[order[twin[1:] | twin[:-1]]]
        np.add.at(covered, again, 1)
        np.add.at(covered, again + window, -1)
    return np.cumsum(covered[:-1]) > 0


def _document(words: list[bytes], covered: np.ndarray, shortest: int) -> tuple:
    """The results for one document's words (already folded)."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], covered.view(np.int8), [0]])))
    found = []
    for a, b in zip(edges[0::2].tolist(), edges[1::2].tolist(), strict=True):
        if b - a >= shortest:
            ids: dict[bytes, int] = {}
            symbols = [ids.setdefault(w, len(ids)) for w in words[a:b]]
            rows = runs_of(symbols, len(ids), shortest)
            rows[:, 0] += a
            found.append(rows)
    runs = np.concatenate(found) if found else np.empty((0, 3), dtype=np.int64)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs.tolist())
    if len(runs):
        s, n, q = runs[np.lexsort((runs[:, 2], runs[:, 0], -runs[:, 1]))[0]].tolist()
        best = (s, n, q, 1000 * n // q)
        edge = np.zeros(len(words) + 1, dtype=np.int64)
        np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
        np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
        words = [w for w, g in zip(words, np.cumsum(edge).tolist(), strict=False) if not g]
    else:
        best = (None,) * 4
    kept = b" ".join(words)
    return (len(runs), *best, hashlib.sha256(listed.encode()).hexdigest(),
            hashlib.sha256(kept).hexdigest(), runs, kept)


def _work(fold: bool, shortest: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    # a run of length >= max(shortest, 2q) with period q repeats windows of
    # max(shortest - q, q) >= shortest / 2 words, at a distance of q
    window = (shortest + 1) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches):
            t = Texts(texts)
            starts, ends, doc = t.words()
            counts = t.per_doc(doc)
            source = np.arange(len(starts))
            first = np.concatenate([[0], np.cumsum(counts)])
            if fold:
                for k, i in enumerate(batch.column(0).to_pylist()):
                    moved = _folded(i, int(counts[k]))
                    if moved is not None:
                        source[first[k] : first[k + 1]] = first[k] + moved
            hashes = span_hashes(t.data, starts, ends)[source]
            covered = _covered(hashes, doc, window)
            starts, ends, data = starts[source].tolist(), ends[source].tolist(), t.data.tobytes()
            out = []
            for k in range(t.n):
                a, b = int(first[k]), int(first[k + 1])
                words = [data[x:y] for x, y in zip(starts[a:b], ends[a:b], strict=True)]
                out.append((b - a, *_document(words, covered[a:b], shortest)))
            cols = list(zip(*out, strict=True))
            arrays = [batch.column(0)]
            arrays += [pa.array(c, pa.int64()) for c in cols[:6]]
            arrays += [pa.array(c, pa.string()) for c in cols[6:8]]
            flat = np.concatenate(cols[8])
            cuts = np.concatenate([[0], np.cumsum([len(r) for r in cols[8]])]).astype(np.int32)
            rows = pa.StructArray.from_arrays([pa.array(flat[:, c]) for c in range(3)],
                                              fields=list(_RUN))
            arrays.append(pa.ListArray.from_arrays(pa.array(cuts), rows))
            arrays.append(pa.array(cols[9], pa.binary()))
            yield pa.RecordBatch.from_arrays(arrays, names=_NAMES)

    return run


def periodic_runs(spark: SparkSession, docs: DataFrame, fold: bool = False,
                  shortest: int = SHORTEST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Runs of words of whole texts, and the texts with each run cut to its first period.

    One row a document: doc_id, n_words, n_runs, the run of greatest length (ties: smallest start,
    then period) as start, length, period and exponent_milli = floor(1000 * length / period),
    digests of the list of runs and of the collapsed text, and both themselves: ``runs`` (start,
    length, period; by start, then period) and ``collapsed`` (UTF-8 bytes).  Runs have
    at least ``shortest`` words and two periods.

    ``fold``: documents the CRC-32 of whose decimal id is divisible by 10 are made periodic from a
    word on that the CRC names (see `_folded`); a null id is not folded.

    Null and empty texts and texts without a word: no words, no runs, digests of nothing.  Rows are
    independent: repeated rows and ids give a row each, an empty table none; other columns are
    ignored.  A text of any length is searched whole: a stretch of n candidate words takes a few
    hundred bytes a word in the task that has it."""
    ship(spark)
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(_work(fold, shortest), _OUT).withColumnRenamed("id", "doc_id")
