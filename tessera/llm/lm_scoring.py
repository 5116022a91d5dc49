"""LM scoring: a smoothed n-gram model, run as a weighted backoff automaton.

Model.  Interpolated absolute discounting over words, on an add-half unigram floor:

    p(w)        = (c(w) + 0.5) / (N + 0.5 (V + 1))
    p(w | h)    = max(c(h w) - D, 0) / c(h) + back(h) p(w | h without its first word)

with ``c(h w)`` kept from ``min_count`` up; ``back(h)`` is the mass the kept n-grams leave, so every
distribution sums to one.  Each word and each kept n-gram up to ``order`` - 1 words is a history, and
each history a *state*: the model grows with the corpus.

Automaton.  States are the empty history and the histories above.  A state has an arc for each kept
n-gram, weighted by its log-probability, to the longest state that ends the text read; where a word
has no arc the failure arc, weighted by the log of ``back``, leads to the longest shorter state that
ends there too.  The empty history has an arc for each word.  A text is read once from left to right;
it carries its state, and its score is the sum of the weights on its way.

A text is tokenised once, when it is written to its block: a block holds the hashes of its distinct
tokens and, of each token, the number of its hash.

On Spark, no task holds the whole model, and none of it is collected or broadcast.  Counts are summed
by key bucket over the block exchange (``blocks.py``), and each block gets the counts of its own
n-grams back; one of the blocks that have an n-gram owns it.  A last exchange sums what the
owned n-grams of a history keep, and each block gets the sums of its own histories: together that is
the part of the automaton that its texts can reach.  n-grams of which a part is not kept are never
asked about, as they cannot be kept either.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.blocks import Block, Blocks, answer, from_planes, groups, planes, said, stable_order
from tessera.llm.hashing import JOIN, mix, span_hashes, word_spans

BLOCK_BYTES = 4 << 20
END = np.uint64(0xE0F1D2C3B4A59687)  # the token that ends a text
RESULT = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
          "base_score double, score double")
_RESULT_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
    ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()),
    ("score", pa.float64())])


#: Marks the answer of the block that owns an n-gram.
OWNED = np.uint64(1 << 63)
_KEPT = np.dtype([("n", "<u4"), ("total", "<u8")])


@dataclass
class Model:
    """What every task knows: the parameters and the totals of the training documents."""

    folds: int
    held_out: int
    discount: float
    min_count: int
    state_share: float
    tokens: int = 0
    types: int = 0

    def base(self, count: np.ndarray) -> np.ndarray:
        return (count + 0.5) / (self.tokens + 0.5 * (self.types + 1))

    def least(self) -> float:
        return max(1.0, self.state_share * self.tokens)


@dataclass
class _Grams:
    """The n-grams of one order that a block asks about."""

    at: np.ndarray | None  # tokens that end one; None: all
    of: np.ndarray       # the number of each
    where: np.ndarray    # of each distinct one, a token that ends it
    keys: np.ndarray     # distinct keys, ascending
    history: np.ndarray  # of each distinct one, the number of the n-gram without its last word
    count: np.ndarray | None = None  # count in all training documents, 0 if not kept
    owned: np.ndarray | None = None


def _tokenised(body: bytes, lens: np.ndarray) -> bytes:
    """What a block holds: the tokens of each document, the hashes of distinct tokens, ascending, and
    the number of each token's hash.  ``lens`` is below 0 for null texts."""
    data = np.frombuffer(body.lower(), dtype=np.uint8)  # A-Z only
    starts, ends = word_spans(data)
    lens = np.maximum(lens, 0)
    # words lie in one document each, in its order: a search a document tells how many it has
    size = np.diff(np.searchsorted(starts, np.cumsum(lens + 1) - 1 - lens), append=len(starts)) + 1
    hashes = np.empty(int(size.sum()), dtype=np.uint64)
    is_end = np.zeros(len(hashes), dtype=bool)
    is_end[np.cumsum(size) - 1] = True
    hashes[is_end] = END
    hashes[~is_end] = span_hashes(data, starts, ends)
    keys, of = np.unique(hashes, return_inverse=True)
    return b"".join([np.array([len(keys), len(of)], dtype=np.int64).tobytes(), planes(size),
                     planes(keys, True), planes(of.astype(np.uint32))])


class _Tokens:
    """The tokens of a block: the hash of each as a number, the document, training or not."""

    def __init__(self, block: Block, model: Model):
        self.block, self.model = block, model
        n_docs, at = len(block.ids), 16
        n_keys, n = np.frombuffer(block.data[:at].tobytes(), dtype=np.int64).tolist()

        def read(items: int, dtype: str, ascending: bool = False) -> np.ndarray:
            nonlocal at
            a, at = at, at + items * np.dtype(dtype).itemsize
            return from_planes(block.data[a:at], dtype, ascending)

        size = read(n_docs, "i8")
        self.keys, self.word = read(n_keys, "u8", True), read(n, "u4").astype(np.int64)
        self.first = np.cumsum(size) - size
        self.size = size
        self.held = np.array([i is not None and zlib.crc32(str(i).encode()) % model.folds
                              == model.held_out for i in block.ids], dtype=bool)
        self.train = np.repeat(~self.held, size)
        self.orders: list[_Grams] = []
        self._ends: dict[tuple[int, bool], np.ndarray] = {}

    def grams(self, order: int) -> _Grams:
        """n-grams of this order whose history is a state and whose last words are kept."""
        if order == 1:
            where = np.empty(len(self.keys), dtype=np.int64)
            where[self.word] = np.arange(len(self.word))
            return _Grams(None, self.word, where, self.keys, np.zeros(len(self.keys), np.int64))
        history = np.full(len(self.word), -1, dtype=np.int64)
        history[1:] = self.states(order - 1)[:-1]
        history[self.first] = -1
        at = np.flatnonzero((history >= 0) & (self.kept(order - 1) >= 0))
        history = history[at]
        # join_hashes, its left part once a history
        left = mix(self.orders[order - 2].keys) * JOIN[0] + JOIN[1]
        grams = mix(left[history] + self.keys[self.word[at]])
        order_ = stable_order(grams)
        sorted_ = grams[order_]
        new = np.empty(len(grams), dtype=bool)
        new[:1] = True
        np.not_equal(sorted_[1:], sorted_[:-1], out=new[1:])
        of = np.empty(len(grams), dtype=np.int64)
        of[order_] = np.cumsum(new) - 1
        some = order_[new]
        return _Grams(at, of, at[some], sorted_[new], history[some])

    def seen(self, g: _Grams) -> np.ndarray:
        """Of each n-gram, its count in the block's training documents."""
        train = self.train if g.at is None else self.train[g.at]
        return np.bincount(g.of[train], minlength=len(g.keys))

    def learn(self, upto: int, known: dict) -> None:
        """Take the counts of the orders up to ``upto`` from the answers."""
        for order in range(len(self.orders) + 1, upto + 1):
            g = self.grams(order)
            got = said(known, f"order{order}", len(g.keys), "u8", packed=True)
            g.count, g.owned = (got & ~OWNED).astype(np.int64), got >= OWNED
            self.orders.append(g)

    def is_kept(self, order: int) -> np.ndarray:
        return self.orders[order - 1].count >= max(1, self.model.min_count)

    def is_state(self, order: int) -> np.ndarray:
        g = self.orders[order - 1]
        return (g.count >= self.model.least()) & (g.keys != END)

    def kept(self, order: int) -> np.ndarray:
        """The kept n-gram that ends at each token, or -1."""
        return self._ending(order, False, self.is_kept(order))

    def states(self, order: int) -> np.ndarray:
        """The state of so many words that ends at each token, or -1."""
        return self._ending(order, True, self.is_state(order))

    def _ending(self, order: int, states: bool, ok: np.ndarray) -> np.ndarray:
        if (order, states) not in self._ends:
            g = self.orders[order - 1]
            if (order, not states) in self._ends and np.array_equal(self.is_kept(order), self.is_state(order)):
                return self._ends[order, not states]
            number = np.where(ok, np.arange(len(ok)), -1)
            if g.at is None:
                ends = number[g.of]
            else:
                ends = np.full(len(self.word), -1, dtype=np.int64)
                ends[g.at] = number[g.of]
            self._ends[order, states] = ends
        return self._ends[order, states]

    def histories(self, order: int) -> np.ndarray:
        """Numbers of the histories of ``order`` words that may have kept n-grams."""
        g = self.orders[order - 1]
        return np.flatnonzero((g.count >= max(self.model.least(), self.model.min_count))
                              & (g.keys != END))

    def left_keys(self):
        """Keys of the histories of all orders, ascending, with the order that sorts them."""
        keys = np.concatenate([np.empty(0, np.uint64), *[
            mix(self.orders[k - 1].keys[self.histories(k)] ^ np.uint64(k))
            for k in range(1, len(self.orders))]])
        by = stable_order(keys)
        return keys[by], by

    def backs(self, known: dict) -> list[np.ndarray]:
        """Per order, the backoff of each n-gram as a history; 1 where nothing of it is kept."""
        keys, by = self.left_keys()
        left = np.empty(len(keys))
        left[by] = said(known, "left", len(keys), "f8", packed=True)
        out, a = [], 0
        for k in range(1, len(self.orders)):
            some = self.histories(k)
            out.append(np.ones(len(self.orders[k - 1].keys)))
            out[-1][some] -= left[a : a + len(some)] / self.orders[k - 1].count[some]
            a += len(some)
        return out


def _summed(keys: np.ndarray, marks: np.ndarray):
    order, starts = groups(keys)
    total = np.add.reduceat(marks[order], starts)
    size = np.diff(np.append(starts, len(keys)))
    return order, starts, size, total


def _decide_words(keys, more, marks, row):
    """Counts of words; the summary holds the number of types and tokens."""
    order, starts, size, total = _summed(keys, marks.astype(np.uint64))
    out = np.empty(len(keys), dtype=np.uint64)
    out[order] = np.repeat(total, size)
    return out, np.array([np.count_nonzero(total), total.sum()], dtype=np.uint64).tobytes()


def _decide_grams(min_count: int):
    """Kept counts, and which block owns the n-gram: the first that has it."""
    def decide(keys, more, marks, row):
        order, starts, size, total = _summed(keys, marks.astype(np.uint64))
        total[total < min_count] = 0
        out = np.empty(len(keys), dtype=np.uint64)
        out[order] = np.repeat(total, size)
        out[order[starts]] |= OWNED
        return out
    return decide


def _decide_left(discount: float):
    """Of each history, what its kept n-grams keep after the discount."""
    def decide(keys, more, marks, row):
        order, starts, size, n = _summed(keys, marks["n"].astype(np.int64))
        total = np.add.reduceat(marks["total"].astype(np.int64)[order], starts)
        out = np.empty(len(keys))
        out[order] = np.repeat(total - discount * n, size)
        return out
    return decide


def _totals(answers: DataFrame):
    """Types and tokens of all buckets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bits in batch.column(0):
                types, tokens = np.frombuffer(bits.as_py(), dtype=np.int64).tolist()
                yield pa.RecordBatch.from_pydict({"types": [types], "tokens": [tokens]})

    return (answers.filter("block = -1").select("bits").mapInArrow(run, "types long, tokens long")
            .agg(F.sum("types"), F.sum("tokens")).first())


class Automaton:
    """The part of the automaton that a block's texts can reach.

    State 0 is the empty history.  ``fail`` and ``fail_weight`` are the failure arcs.  An arc's key is
    state x words + word, in ascending order; those of state 0 are by word."""

    def __init__(self, tokens: _Tokens, known: dict):
        model, words = tokens.model, tokens.orders[0]
        self.tokens, self.word, self.n_words = tokens, words.of, len(words.keys)
        self.base = model.base(words.count.astype(np.float64))
        # by order: the longest state of so many words that ends at each token
        ends = [np.zeros(len(self.word), dtype=np.int64)]
        number = []  # of each n-gram, its state
        self.n_states = 1
        fail, fail_weight = [np.zeros(1, dtype=np.int64)], [np.zeros(1)]
        for k, back in enumerate(tokens.backs(known), 1):
            g, at, is_state = tokens.orders[k - 1], tokens.states(k), tokens.is_state(k)
            number.append(np.where(is_state, self.n_states - 1 + np.cumsum(is_state), -1))
            self.n_states += np.count_nonzero(is_state)
            fail.append(ends[-1][g.where[is_state]])
            fail_weight.append(np.log10(back[is_state]))
            ends.append(ends[-1].copy())
            ends[-1][at >= 0] = number[-1][at[at >= 0]]
        self.fail, self.fail_weight = np.concatenate(fail), np.concatenate(fail_weight)
        top = len(ends) - 1
        # from the arcs of the empty history up, each adds its share to that of the shorter history
        self.first_weight, self.first_to = np.log10(self.base), ends[min(1, top)][words.where]
        keys, weights, to = [np.empty(0, np.int64)], [np.empty(0)], [np.empty(0, np.int64)]
        shorter = self.base
        back = 10.0 ** self.fail_weight
        for k in range(2, len(tokens.orders) + 1):
            g, h = tokens.orders[k - 1], tokens.orders[k - 2]
            state = number[k - 2][g.history]
            share = np.maximum(g.count - model.discount, 0) / h.count[g.history]
            lower = tokens.kept(k - 1)[g.where]
            chance = share + back[state] * shorter[lower]
            kept = tokens.is_kept(k)
            keys.append(state[kept] * self.n_words + self.word[g.where[kept]])
            weights.append(np.log10(chance[kept]))
            to.append(ends[min(k, top)][g.where[kept]])
            shorter = chance
        arcs = np.concatenate(keys)
        by = stable_order(arcs.view(np.uint64))
        self.arc = np.append(arcs[by], np.iinfo(np.int64).max)
        self.arc_weight, self.arc_to = np.concatenate(weights)[by], np.concatenate(to)[by]

    def _step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Read a word in each state: the states after it, and the weights of the arcs taken."""
        to, weight = np.empty_like(state), np.zeros(len(state))
        open_ = np.arange(len(state))
        while True:
            empty = state[open_] == 0
            done = open_[empty]
            to[done] = self.first_to[word[done]]
            weight[done] += self.first_weight[word[done]]
            open_ = open_[~empty]
            if not len(open_):
                return to, weight
            key = state[open_] * self.n_words + word[open_]
            arc = np.empty(len(key), dtype=np.int64)
            by = np.argsort(key)  # a search in order stays in the cache
            arc[by] = np.searchsorted(self.arc, key[by])
            has = self.arc[arc] == key
            done, arc = open_[has], arc[has]
            to[done] = self.arc_to[arc]
            weight[done] += self.arc_weight[arc]
            open_ = open_[~has]
            weight[open_] += self.fail_weight[state[open_]]
            state[open_] = self.fail[state[open_]]

    def run(self, stretch: int = 64) -> np.ndarray:
        """Log-probability of each token (``stretch`` does not change it).  All texts run from left to right side by side, each
        carrying its state.  A long text runs in stretches; all but its first start in the empty
        state as many words early as a state holds, after which the state is that of the whole text."""
        tokens, early = self.tokens, len(self.tokens.orders) - 1
        n = len(self.word)
        at = np.arange(n) - np.repeat(tokens.first, tokens.size)
        begin = np.flatnonzero(at % stretch == 0)
        size = np.diff(np.append(begin, n))
        warm = np.minimum(at[begin], early)
        begin, size = begin - warm, size + warm
        by = np.argsort(-size, kind="stable")
        begin, size, warm = begin[by], size[by], warm[by]
        out, state = np.empty(n), np.zeros(len(begin), dtype=np.int64)
        for step in range(size[0] if len(size) else 0):
            live = np.searchsorted(-size, -step, side="left")
            here = begin[:live] + step
            state[:live], weight = self._step(state[:live], self.word[here])
            read = warm[:live] <= step
            out[here[read]] = weight[read]
        return out


def lm_scores(spark: SparkSession, docs: DataFrame, order: int = 3, folds: int = 5,
              held_out: int = 1, discount: float = 0.75, min_count: int = 2,
              state_share: float = 0.0, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """One row a document: its log10 probability under the n-gram model of the training documents.

    Documents whose crc32(id as text) mod ``folds`` is ``held_out`` do not train.  Tokens are the
    words ``[^\\x20\\x09-\\x0D]+`` after A-Z is lower-cased, then one end token.  The model is that of
    the module, of ``order`` words.  A ``state_share`` above 0 leaves out the histories that make up
    less than that share of the training tokens.

    Null, empty and blank texts are the end token alone.  Documents with a null id train.  Rows with
    equal ids are texts of their own.  With no training document the floor alone scores.  An empty
    table gives no rows.  Other columns are ignored.

    Returns doc_id, held_out, n_tokens, n_known (tokens seen in training), train_tokens, base_score
    (the unigram floor's log10 probability), score.
    """
    blocks = Blocks(spark, docs, BLOCK_BYTES, id_col, text_col, encode=_tokenised)
    model = Model(folds, held_out, discount, min_count, state_share)
    known: dict[str, DataFrame] = {}
    for n in range(1, order + 1):
        def grams(block: Block, known: dict, n=n):
            tokens = _Tokens(block, model)
            tokens.learn(n - 1, known)
            g = tokens.grams(n)
            return g.keys, None, tokens.seen(g).astype(np.uint32)

        asked = blocks.ask(grams, blocks.buckets(0.03 if n == 1 else 0.08), dict(known), packed=True)
        known[f"order{n}"] = answer(asked, _decide_grams(min_count) if n > 1 else _decide_words,
                                    "u8", None, "u4", name=f"order{n}", packed=True)
        if n == 1:
            totals = _totals(known["order1"])
            model.types, model.tokens = (int(x or 0) for x in totals)

    def left(block: Block, known: dict):
        tokens = _Tokens(block, model)
        tokens.learn(order, known)
        marks = [np.empty(0, dtype=_KEPT)]
        for n in range(2, order + 1):
            g = tokens.orders[n - 1]
            mine = g.owned & (g.count > 0)
            part = np.zeros(len(tokens.orders[n - 2].keys), dtype=_KEPT)
            part["n"] = np.bincount(g.history[mine], minlength=len(part))
            # exact below 2^53
            part["total"] = np.bincount(g.history[mine], weights=g.count[mine], minlength=len(part))
            marks.append(part[tokens.histories(n - 1)])
        keys, by = tokens.left_keys()
        return keys, None, np.concatenate(marks)[by]

    known["left"] = answer(blocks.ask(left, blocks.buckets(0.08), dict(known), packed=True),
                           _decide_left(discount), "u8", None, _KEPT, name="left", packed=True)

    def finish(block: Block, known: dict) -> list[pa.RecordBatch]:
        tokens = _Tokens(block, model)
        tokens.learn(order, known)
        automaton = Automaton(tokens, known)
        base, seen = np.log10(automaton.base)[automaton.word], tokens.orders[0].count > 0
        n = len(block.ids)
        return [pa.RecordBatch.from_arrays([
            pa.array(block.ids, type=pa.int64()), pa.array(tokens.held),
            pa.array(tokens.size),
            pa.array(np.add.reduceat(seen[automaton.word].astype(np.int64), tokens.first)),
            pa.array(np.full(n, model.tokens, dtype=np.int64)),
            pa.array(np.add.reduceat(base, tokens.first)),
            pa.array(np.add.reduceat(automaton.run(), tokens.first), type=pa.float64())],
            schema=_RESULT_ARROW)]

    return blocks.visit(finish, RESULT, _RESULT_ARROW, known)
