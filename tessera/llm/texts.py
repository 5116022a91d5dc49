"""A batch of texts as one array of bytes, with per-document features computed when asked for."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from tessera.llm.hashing import join_hashes, mix, span_hashes, windows_of, word_spans

#: Bytes of text that are worked on in one go (a longer text goes alone).
CHUNK = 1 << 20


def chunks(batches: Iterator[pa.RecordBatch], size: int = CHUNK
           ) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Runs of rows of about ``size`` bytes of text; column 1 holds the text (null: empty)."""
    for batch in batches:
        start, texts, held = 0, [], 0
        for k, text in enumerate(batch.column(1)):
            texts.append(text.as_py() or b"")
            held += len(texts[-1])
            if held >= size or k + 1 == batch.num_rows:
                yield batch.slice(start, len(texts)), texts
                start, texts, held = k + 1, [], 0


class Texts:
    """Documents in one buffer, each followed by a line feed."""

    def __init__(self, texts: list[bytes]):
        self.n = len(texts)
        self.data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        lens = np.fromiter(map(len, texts), dtype=np.int64, count=self.n)
        self.ends = np.cumsum(lens + 1) - 1
        self.starts = self.ends - lens
        self._texts = texts
        self._held: dict[str, np.ndarray] = {}
        self._words: tuple | None = None

    def take(self, rows: np.ndarray) -> Texts:
        """Some of the documents; features known here stay known there."""
        if len(rows) == self.n:
            return self
        out = Texts([self._texts[k] for k in rows.tolist()])
        out._held = {k: v[rows] for k, v in self._held.items()}
        return out

    def get(self, name: str) -> np.ndarray:
        if name not in self._held:
            self._held[name] = FEATURES[name](self)
        return self._held[name]

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and document of each word."""
        if self._words is None:
            starts, ends = word_spans(self.data)
            self._words = starts, ends, np.searchsorted(self.starts, starts, side="right") - 1
        return self._words

    def count(self, mask: np.ndarray) -> np.ndarray:
        """Marked bytes of each document."""
        total = np.concatenate([[0], np.cumsum(mask)])
        return total[self.ends] - total[self.starts]

    def per_doc(self, doc: np.ndarray) -> np.ndarray:
        return np.bincount(doc, minlength=self.n).astype(np.int64)


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(chars)] = True
    return out


SYMBOLS = _table(b"#*$%&|<>")
UPPER = _table(bytes(range(65, 91)))
LETTER = _table(bytes(range(65, 91)) + bytes(range(97, 123)))


def _word_chars(t: Texts) -> np.ndarray:
    starts, ends, doc = t.words()
    # code points are the bytes that do not continue one
    total = np.concatenate([[0], np.cumsum((t.data & 0xC0) != 0x80)])
    return np.bincount(doc, weights=total[ends] - total[starts], minlength=t.n).astype(np.int64)


def _lines(t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and document of the lines that have a word."""
    ends = np.flatnonzero(t.data == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    word = t.words()[0]
    full = np.searchsorted(word, ends) > np.searchsorted(word, starts)
    starts, ends = starts[full], ends[full]
    return starts, ends, np.searchsorted(t.starts, starts, side="right") - 1


def _in_doc(hashes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    return join_hashes(mix(doc.astype(np.uint64)), hashes)


def _n_dup_lines(t: Texts) -> np.ndarray:
    starts, ends, doc = _lines(t)
    keys = _in_doc(span_hashes(t.data, starts, ends), doc)
    _, first = np.unique(keys, return_index=True)
    return t.per_doc(doc) - t.per_doc(doc[first])


def _n_repeat_words(t: Texts, window: int = 5) -> np.ndarray:
    starts, ends, doc = t.words()
    if len(starts) < window:
        return np.zeros(t.n, dtype=np.int64)
    keys = _in_doc(windows_of(span_hashes(t.data, starts, ends), window), doc[: 1 - window])
    inside = np.flatnonzero(doc[: 1 - window] == doc[window - 1 :])
    _, of, count = np.unique(keys[inside], return_inverse=True, return_counts=True)
    again = inside[count[of] > 1]
    edge = np.zeros(len(starts) + 1, dtype=np.int32)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + window, -1)
    return t.per_doc(doc[np.cumsum(edge[:-1]) > 0])


def _n_stutters(t: Texts) -> np.ndarray:
    starts, ends, doc = t.words()
    h = span_hashes(t.data, starts, ends)
    return t.per_doc(doc[1:][(h[1:] == h[:-1]) & (doc[1:] == doc[:-1])])


#: Per-document features.
FEATURES: dict[str, Callable[[Texts], np.ndarray]] = {
    "n_words": lambda t: t.per_doc(t.words()[2]),
    "word_chars": _word_chars,
    "n_symbols": lambda t: t.count(SYMBOLS[t.data]),
    "n_upper": lambda t: t.count(UPPER[t.data]),
    "n_letters": lambda t: t.count(LETTER[t.data]),
    "n_exclaims": lambda t: t.count(t.data == 33),
    "n_lines": lambda t: t.per_doc(_lines(t)[2]),
    "n_dup_lines": _n_dup_lines,
    "n_repeat_words": _n_repeat_words,
    "n_stutters": _n_stutters,
}
