"""Quality rules: a short-circuit cascade, ordered by rejection per cost.

Each rule rejects some documents at some cost.  Both are estimated on a bounded sample: a rule's
cost is the CPU time a document of computing what it reads, its selectivity the share it rejects.
Rules then run in order of rejection per cost, each on the documents that all rules before it have
kept.  The order changes the work, never the verdict: a document is kept if no rule rejects it.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import ship
from tessera.llm.texts import Texts, chunks


@dataclass(frozen=True)
class Rule:
    """``rejects`` maps the features it reads to a mask of documents."""

    name: str
    reads: tuple[str, ...]
    rejects: Callable[..., np.ndarray]


#: The first two are the base rules.
RULES = (
    Rule("too_few_words", ("n_words",), lambda n: n < 10),
    Rule("repeated_passages", ("n_repeat_words", "n_words"), lambda r, n: 100 * r > 20 * n),
    Rule("symbols", ("n_symbols", "n_words"), lambda s, n: 10 * s > n),
    Rule("repeated_lines", ("n_dup_lines", "n_lines"), lambda d, n: 2 * d > n),
    Rule("shouting", ("n_upper", "n_letters"), lambda u, n: 2 * u > n),
    Rule("exclamations", ("n_exclaims", "n_words"), lambda e, n: 2 * e > n),
    Rule("stutter", ("n_stutters", "n_words"), lambda s, n: 2 * s > n),
    Rule("word_length", ("word_chars", "n_words"), lambda c, n: (c < 2 * n) | (c > 20 * n)),
)
BASE = ("too_few_words", "repeated_passages")
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _rejected(rule: Rule, texts: Texts) -> np.ndarray:
    return rule.rejects(*[texts.get(name) for name in rule.reads])


def estimate(docs: DataFrame, rules: tuple[Rule, ...], sample_docs: int = 2000,
             id_col: str = "doc_id", text_col: str = "text") -> list[tuple[str, float, float]]:
    """(rule, CPU seconds a document, share rejected), from a sample of about ``sample_docs``
    documents (all of them in a smaller table)."""
    ship(docs.sparkSession)
    total = docs.count()
    share = min(1.0, sample_docs / max(1, total))
    hashed = F.pmod(F.xxhash64(F.col(id_col), F.lit(8)), F.lit(1_000_000))
    sample = docs.filter(hashed < int(share * 1_000_000) + 1) if share < 1 else docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in chunks(batches):
            out = []
            for rule in rules:
                began = time.thread_time()
                n = int(np.count_nonzero(_rejected(rule, Texts(texts))))
                out.append((rule.name, time.thread_time() - began, n, len(texts)))
            cols = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols],
                                             names=["rule", "seconds", "rejected", "docs"])

    got = (sample.select(F.col(id_col), F.col(text_col).cast("binary").alias("text"))
           .mapInArrow(run, "rule string, seconds double, rejected long, docs long")
           .groupBy("rule").agg(F.sum("seconds"), F.sum("rejected"), F.sum("docs")).collect())
    found = {r[0]: (r[1] / r[3], r[2] / r[3]) for r in got}
    return [(rule.name, *found.get(rule.name, (0.0, 0.0))) for rule in rules]


def ordered(rules: tuple[Rule, ...], estimates: list[tuple[str, float, float]]) -> list[Rule]:
    """Rules by rejection per cost, the most first."""
    worth = {name: rejected / max(cost, 1e-9) for name, cost, rejected in estimates}
    return sorted(rules, key=lambda r: -worth[r.name])


def quality_cascade(spark: SparkSession, docs: DataFrame, rules: tuple[Rule, ...] = RULES,
                    report: bool = False, sample_docs: int = 2000, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row a document: doc_id and kept.

    With ``report`` the statistics of STATS and base_failed come too; they need the whole of each
    text, also of those that a cheap rule rejects, so only the other rules save work then.

    Words are ``[^\\x20\\x09-\\x0D]+``.  Null, empty and blank texts have no words and are rejected for
    that.  Rows with equal or null ids are judged one by one.  An empty table gives no rows.  Other
    columns are ignored.
    """
    plan = ordered(rules, estimate(docs, rules, sample_docs, id_col, text_col))
    base = [r for r in rules if r.name in BASE]
    fields = [("doc_id", pa.int64())]
    if report:
        fields += [*((s, pa.int64()) for s in STATS), ("base_failed", pa.bool_())]
    schema = pa.schema([*fields, ("kept", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw in chunks(batches):
            texts = Texts(raw)
            cols = [rows.column(0)]
            if report:
                cols += [pa.array(texts.get(s)) for s in STATS]
                failed = np.zeros(texts.n, dtype=bool)
                for rule in base:
                    failed |= _rejected(rule, texts)
                cols.append(pa.array(failed))
            left = np.arange(texts.n)
            for rule in plan:
                if not len(left):
                    break
                alive = np.flatnonzero(~_rejected(rule, texts))
                left, texts = left[alive], texts.take(alive)
            kept = np.zeros(len(raw), dtype=bool)
            kept[left] = True
            yield pa.RecordBatch.from_arrays([*cols, pa.array(kept)], schema=schema)

    kinds = {pa.int64(): "long", pa.bool_(): "boolean"}
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.col(text_col).cast("binary").alias("text")).mapInArrow(
                           run, ", ".join(f"{f.name} {kinds[f.type]}" for f in schema))
