"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit verification.

Texts and benchmark items are sequences of words: A-Z lowered, ASCII punctuation removed, split at
white space.  An item leaks into a text where a part of the text is within ``max_edits`` word edits
(a share of the item's words) of it.

0. *Pieces.*  The longer the window, the further walks drift apart, so an item of ``2 * PIECE`` words
   or more is cut into pieces of ``PIECE`` words or a little more.  If the item is within its bound,
   some piece is within its own; what follows finds pieces, and each found one makes its item a
   candidate.
1. *Windows.*  Within the bound an item of n words and e edits keeps a run of (n - e) / (e + 1)
   words, so only item-sized windows aligned on a run that some item has too (``RUN`` words, or the
   shorter run that a short item guarantees) can match.  All others are skipped; nothing is lost.
2. *CGK.*  A window is read by a random walk: at step j the word under the pointer is emitted, and
   the pointer moves on or stays as a random bit of (repetition, j, word) says.  Windows at a small
   edit distance walk together again soon after each edit, so edit distance becomes Hamming
   distance of the emitted words.
3. *LSH.*  Each repetition samples a few steps of the walk; windows and items of one size whose
   samples agree in any repetition are candidates.  The number of repetitions follows from the
   target recall.
4. *Verification.*  The least word edit distance of the item to any part of the text around the
   window, exact, and of the whole item.

The benchmark goes to every task, in blocks of a bounded size, one pass over the texts each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import ship
from tessera.llm.hashing import IS_SPACE, join_hashes, mix, span_hashes, windows_of, word_spans
from tessera.llm.texts import chunks

RESULT = ("doc_id long, item_id long, distance long, item_words long, start_word long, "
          "end_word long, found string")
_RESULT_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("item_id", pa.int64()), ("distance", pa.int64()),
    ("item_words", pa.int64()), ("start_word", pa.int64()), ("end_word", pa.int64()),
    ("found", pa.string())])
#: Words of the longest run that is looked up.
RUN = 4
#: Bytes of benchmark text that go to every task at once.
ITEM_BYTES = 1 << 20
#: Least words of a piece of an item; pieces have less than twice as many.
PIECE = 20
#: Chance that a sampled step agrees at the edit bound of a piece; the tests measure the recall.
AGREE = 0.35

_NORMAL = np.arange(256, dtype=np.uint8)
_NORMAL[65:91] += 32
_NORMAL[IS_SPACE] = 32
_DROPPED = np.zeros(256, dtype=bool)
_DROPPED[:128] = True
_DROPPED[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False
_DROPPED[IS_SPACE] = False


class Words:
    """Normalised words of several texts: hashes and the range of each text."""

    def __init__(self, texts: list[bytes]):
        raw = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        keep = ~_DROPPED[raw]
        self.data = _NORMAL[raw[keep]]
        lens = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        before = np.concatenate([[0], np.cumsum(keep)])
        ends = before[np.cumsum(lens + 1) - 1]
        self.starts, self.ends = word_spans(self.data)
        self.hash = span_hashes(self.data, self.starts, self.ends)
        self.cuts = np.concatenate([[0], np.searchsorted(self.starts, ends)])
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.cuts))

    def text(self, a: int, b: int) -> str:
        return b" ".join(self.data[s:e].tobytes() for s, e in
                         zip(self.starts[a:b], self.ends[a:b], strict=True)).decode("utf-8", "replace")


def bound(n: int, max_edits: float) -> int:
    return int(max_edits * n)


def run_length(n: int, max_edits: float) -> int:
    """Words of the run that ``n`` words keep within the bound, at most RUN."""
    e = bound(n, max_edits)
    return max(1, min(RUN, -(-(n - e) // (e + 1))))


def repetitions(samples: int, recall: float) -> int:
    return math.ceil(math.log(1 - recall) / math.log(1 - AGREE**samples))


def pieces(n: int) -> list[tuple[int, int]]:
    """Ranges of words that an item of ``n`` words is cut into, as equal as can be."""
    parts = max(1, n // PIECE)
    return [(n * k // parts, n * (k + 1) // parts) for k in range(parts)]


class Walks:
    """The random walks of all repetitions over windows of the given sizes."""

    def __init__(self, sizes: list[int], repetitions: int, samples: int):
        self.sizes = np.array(sorted(set(sizes)), dtype=np.int64)
        self.seeds = np.arange(repetitions, dtype=np.uint64)[:, None] << np.uint64(32)
        # sampled[repetition, size, step]; half the steps move on, so 2n steps cover n words
        steps = 2 * int(self.sizes[-1]) if len(self.sizes) else 0
        self.sampled = np.zeros((repetitions, len(self.sizes), steps), dtype=bool)
        for k, n in enumerate(self.sizes.tolist()):
            rng = np.random.Generator(np.random.PCG64([n, 77]))
            for r in range(repetitions):
                picks = rng.choice(2 * n, size=min(samples, 2 * n), replace=False)
                self.sampled[r, k, picks] = True

    def signatures(self, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                   sizes: np.ndarray) -> np.ndarray:
        """Bit-sampled CGK embeddings, a row a repetition and a column a window: ``sizes`` words
        from ``starts`` on, padded from ``ends`` on."""
        out = mix(self.seeds | sizes.astype(np.uint64))
        if not out.size:
            return out
        kind = np.searchsorted(self.sizes, sizes)
        at = np.broadcast_to(starts, out.shape).copy()
        stop = np.minimum(starts + sizes, ends)
        last = len(hashes) - 1
        for j in range(2 * int(sizes.max())):
            word = np.where(at < stop, hashes[np.minimum(at, last)], np.uint64(0))
            hit = self.sampled[:, kind, j]
            if hit.any():
                out[hit] = join_hashes(out[hit], word[hit])
            at += (mix(word ^ (self.seeds + np.uint64(j))) & np.uint64(1)).astype(np.int64)
        return out


class Index:
    """The items of a block: runs to align windows on, and signatures."""

    def __init__(self, ids: list, texts: list[bytes], max_edits: float, samples: int,
                 recall: float, min_words: int):
        words = Words(texts)
        self.max_edits = max_edits
        self.items = [(i, words.hash[a:b]) for i, a, b in
                      zip(ids, words.cuts[:-1], words.cuts[1:], strict=True)
                      if b - a >= min_words]
        # item, offset in it and words of each piece
        self.pieces = [(k, a, h[a:b]) for k, (_, h) in enumerate(self.items)
                       for a, b in pieces(len(h))]
        runs: dict[int, list] = {}
        for _, _, h in self.pieces:
            q = run_length(len(h), max_edits)
            w = windows_of(h, q)
            runs.setdefault(q, []).append(np.stack(
                [w, np.arange(len(w), dtype=np.uint64), np.full(len(w), len(h), dtype=np.uint64)]))
        # run length -> distinct (hash, offset in the piece, piece size), and a bitmap of the hashes
        self.runs = {}
        for q, parts in runs.items():
            table = np.unique(np.concatenate(parts, axis=1), axis=1)
            seen = np.zeros(1 << 20, dtype=bool)
            seen[(table[0] & np.uint64(0xFFFFF)).astype(np.int64)] = True
            self.runs[q] = table, seen
        lens = np.array([len(h) for _, _, h in self.pieces], dtype=np.int64)
        self.walks = Walks(lens.tolist(), repetitions(samples, recall), samples)
        ends = np.cumsum(lens)
        flat = np.concatenate([h for _, _, h in self.pieces]) if self.items else words.hash[:0]
        signs = self.walks.signatures(flat, ends - lens, ends, lens)
        order = np.argsort(signs, axis=None, kind="stable")
        self.signs = signs.ravel()[order]
        self.sign_pieces = np.tile(np.arange(len(lens)), len(signs))[order]

    def windows(self, words: Words) -> np.ndarray:
        """(start, document, size) of the piece-sized windows aligned on a shared run."""
        found = [np.empty((3, 0), dtype=np.int64)]
        for q, (table, seen) in self.runs.items():
            w = windows_of(words.hash, q)
            hit = np.flatnonzero(seen[(w & np.uint64(0xFFFFF)).astype(np.int64)])
            hit = hit[words.doc[hit] == words.doc[hit + q - 1]]
            lo = np.searchsorted(table[0], w[hit], side="left")
            n = np.searchsorted(table[0], w[hit], side="right") - lo
            hit, lo, n = hit[n > 0], lo[n > 0], n[n > 0]
            row = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            at = np.repeat(hit, n)
            doc = words.doc[at]
            start = np.maximum(at - table[1][row].astype(np.int64), words.cuts[doc])
            found.append(np.stack([start, doc, table[2][row].astype(np.int64)]))
        return np.unique(np.concatenate(found, axis=1), axis=1)

    def candidates(self, words: Words) -> set[tuple[int, int, int]]:
        """(document, item, start of the item by the window) that agree in some repetition."""
        start, doc, size = self.windows(words)
        signs = self.walks.signatures(words.hash, start, words.cuts[doc + 1], size)
        lo = np.searchsorted(self.signs, signs, side="left")
        hi = np.searchsorted(self.signs, signs, side="right")
        return {(int(doc[k]), self.pieces[piece][0], int(start[k]) - self.pieces[piece][1])
                for r, k in zip(*np.nonzero(hi > lo), strict=True)
                for piece in self.sign_pieces[lo[r, k] : hi[r, k]].tolist()}

    def leaks(self, words: Words) -> Iterator[tuple[int, int, int, int, int, int]]:
        """(document, item id, distance, item words, start, end): the best place of each item in
        each document, if within the bound.  Places count from the document's first word."""
        spots: dict[tuple[int, int], list[int]] = {}
        for doc, item, start in self.candidates(words):
            spots.setdefault((doc, item), []).append(start)
        for (doc, k), starts in sorted(spots.items()):
            item_id, item = self.items[k]
            e = bound(len(item), self.max_edits)
            best = None
            for a, b in _regions(sorted(starts), len(item), 2 * e, words.cuts[doc],
                                 words.cuts[doc + 1]):
                d, s, t = nearest(item, words.hash[a:b])
                if d <= e and (best is None or d < best[0]):
                    best = d, a + s - words.cuts[doc], a + t - words.cuts[doc]
            if best:
                yield doc, item_id, best[0], len(item), int(best[1]), int(best[2])


def _regions(starts: list[int], n: int, slack: int, first: int, last: int):
    """Parts of the text around the windows, those that overlap joined."""
    a, b = None, None
    for s in starts:
        lo, hi = max(first, s - slack), min(last, s + n + slack)
        if a is not None and lo <= b:
            b = hi
            continue
        if a is not None:
            yield int(a), int(b)
        a, b = lo, hi
    yield int(a), int(b)


def _last_row(item: np.ndarray, text: np.ndarray, free_start: bool) -> np.ndarray:
    """Edit distances of the item to the text up to each place (from anywhere, or from its start)."""
    n = len(text)
    ramp = np.arange(n + 1)
    row = np.zeros(n + 1, dtype=np.int64) if free_start else ramp.copy()
    for i, word in enumerate(item, 1):
        new = np.empty(n + 1, dtype=np.int64)
        new[0] = i
        new[1:] = np.minimum(row[1:] + 1, row[:-1] + (text != word))
        row = np.minimum.accumulate(new - ramp) + ramp
    return row


def nearest(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """(distance, start, end) of the part of the text nearest to the item; the first such end, and
    the longest part that ends there."""
    row = _last_row(item, text, True)
    end = int(row.argmin())
    back = _last_row(item[::-1], text[:end][::-1], False)
    return int(row[end]), end - int(np.flatnonzero(back == back.min())[-1]), end


def contamination(spark: SparkSession, docs: DataFrame, benchmark: DataFrame,
                  max_edits: float = 0.2, samples: int = 2, recall: float = 0.98,
                  min_words: int = 5, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row a document and benchmark item that leaks into it: the best place of the item.

    Null and empty texts leak nothing.  Items under ``min_words`` normalised words (null ones too)
    are too common to look for and are left out.  Rows with equal ids are texts, or items, of their
    own; null ids come back as null.  Either table empty gives no rows.  Other columns are ignored.

    Returns doc_id, item_id, distance (word edits), item_words, start_word and end_word (of the
    document's normalised words), found (those words).
    """
    ship(spark)
    items = benchmark.select(F.col(item_id_col).cast("bigint").alias("item_id"),
                             F.col(item_text_col).cast("binary").alias("text")
                             ).filter(F.col("text").isNotNull())
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = int(total) // ITEM_BYTES + 1
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                        F.col(text_col).cast("binary").alias("text"))
    out = None
    for block in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block)
        rows = sorted(((r[0], bytes(r[1])) for r in part.collect()),
                      key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        shared = spark.sparkContext.broadcast(Index(
            [r[0] for r in rows], [r[1] for r in rows], max_edits, samples, recall, min_words))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for part, raw in chunks(batches):
                ids = part.column(0).to_pylist()
                words = Words(raw)
                found = [(ids[d], *leak, words.text(words.cuts[d] + leak[-2],
                                                    words.cuts[d] + leak[-1]))
                         for d, *leak in index.leaks(words)]
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, type=f.type) for c, f in
                         zip(zip(*found, strict=True), _RESULT_ARROW, strict=True)],
                        schema=_RESULT_ARROW)

        got = texts.mapInArrow(run, RESULT)
        out = got if out is None else out.unionByName(got)
    return out
