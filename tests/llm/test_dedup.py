"""Dedup operators against brute force over awkward documents."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from tessera.llm import simhash
from tessera.llm.line_dedup import line_dedup, within_one_edit
from tessera.llm.simhash import components, simhash_dedup
from tessera.llm.substring_dedup import levels, substring_dedup
from tessera.llm.suffix_dedup import suffix_dedup

LAST = float("inf")


def sha(b: bytes) -> str:
    return hashlib.sha256(b).hexdigest()


def by_id(rows):
    return sorted(rows, key=lambda r: (LAST if r[0] is None else r[0], *map(str, r[1:])))


@pytest.mark.parametrize("threshold", [200, 37])
def test_suffix_dedup(spark, hard_rows, hard_docs, no_docs, threshold):
    texts = [(i, (t or "").encode()) for i, t, _, _ in hard_rows]
    seen = Counter(b[k : k + threshold] for _, b in texts for k in range(len(b) - threshold + 1))
    want = []
    for i, b in texts:
        gone = np.zeros(len(b) + 1, dtype=bool)
        for k in range(len(b) - threshold + 1):
            if seen[b[k : k + threshold]] > 1:
                gone[k : k + threshold] = True
        spans = int(np.count_nonzero(gone[1:] & ~gone[:-1]) + gone[0])
        kept = bytes(x for x, g in zip(b, gone, strict=False) if not g)
        want.append((i, len(b), int(gone.sum()), spans, sha(kept)))
    got = [tuple(r) for r in suffix_dedup(spark, hard_docs, threshold).drop("removed").collect()]
    assert by_id(got) == by_id(want)
    assert suffix_dedup(spark, no_docs).count() == 0


@pytest.mark.parametrize("threshold", [20, 7])
def test_substring_dedup(spark, hard_rows, hard_docs, no_docs, threshold):
    assert levels(20) == [5, 10, 20]
    rows = [r for r in hard_rows if r[0] is not None and r[0] != 210]  # one order alone is defined
    seen, want = set(), []
    for i, t, _, _ in sorted(rows, key=lambda r: r[0]):
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for k in range(len(w) - threshold + 1):
            key = tuple(w[k : k + threshold])
            if key in seen:
                gone[k : k + threshold] = [True] * threshold
            seen.add(key)
        want.append((i, len(w), sum(gone),
                     sha(b" ".join(x for x, g in zip(w, gone, strict=True) if not g))))
    docs = hard_docs.filter("doc_id <> 210")
    got = [tuple(r) for r in substring_dedup(spark, docs, threshold).drop("removed").collect()]
    assert by_id(got) == by_id(want)
    assert substring_dedup(spark, no_docs).count() == 0
    # of two rows with one id, one keeps what the other loses
    twice = substring_dedup(spark, hard_docs.filter("doc_id = 210")).collect()
    assert sorted(r.n_removed > 0 for r in twice) in ([False, True], [False, False])


@pytest.mark.parametrize("crowded", [512, 1])
def test_simhash(spark, monkeypatch, hard_rows, hard_docs, no_docs, crowded):
    monkeypatch.setattr(simhash, "CELL_PAIRS", crowded)
    ids, prints = [], []
    for i, t, _, _ in hard_rows:
        w = (t or "").encode().lower().split()
        grams = [b" ".join(w[k : k + 4]) for k in range(max(1, len(w) - 3))] if w else []
        h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        ids.append(i)
        prints.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    root = list(range(len(ids)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(ids)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                root[find(a)] = find(b)
    least: dict = {}
    for k, i in enumerate(ids):
        if i is not None:
            least[find(k)] = min(least.get(find(k), LAST), i)
    want = [(i, f"{p:016x}", least.get(find(k))) for k, (i, p) in
            enumerate(zip(ids, prints, strict=True))]
    got = [tuple(r) for r in simhash_dedup(spark, hard_docs).drop("fp").collect()]
    assert by_id(got) == by_id(want)
    assert simhash_dedup(spark, no_docs).count() == 0


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(300)] + [(900, 901)], "a long, b long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert got == {**{k: 0 for k in range(301)}, 900: 900, 901: 900}


def test_line_dedup(spark, hard_rows, hard_docs, no_docs):
    rows = [r for r in hard_rows if r[0] is not None and r[0] != 210]
    seen: list[list] = []
    exact, want = set(), []
    for i, t, lang, src in sorted(rows, key=lambda r: r[0]):
        kept, copies, near = [], 0, 0
        for line in (t or "").split("\n"):
            w = line.encode().lower().split()
            if w and tuple(w) in exact:
                copies += 1
                continue
            drop = len(w) >= 5 and any(abs(len(o) - len(w)) < 2 and within_one_edit(o, w)
                                       for o in seen)
            exact.add(tuple(w))
            if len(w) >= 5:
                seen.append(w)
            near += drop
            if not drop:
                kept.append(line)
        left = "\n".join(kept)
        want.append((i, None if t is None else left, lang, src, (t or "").count("\n") + 1, copies,
                     near, sha(left.encode())))
    docs = hard_docs.filter("doc_id <> 210")
    out = line_dedup(spark, docs)
    assert out.columns == [*docs.drop("line_dedup").columns, "line_dedup"]
    got = [tuple(r) for r in out.select("doc_id", "text", "lang", "source", "line_dedup.*").collect()]
    assert by_id(got) == by_id(want)
    assert sum(w[6] for w in want) > 10
    assert line_dedup(spark, no_docs).count() == 0
    assert line_dedup(spark, hard_docs).count() == len(hard_rows)


def test_line_dedup_of_long_periodic_lines(spark):
    unit = "ab " * 40_000
    texts = [unit, unit[3:], unit[6:], "- " * 500_000, "- " * 499_998, "x" * 1_000_000, "x" * 1_000_000,
             "a b c", "A  b\tc", "one two three four five six seven", "one two three 4 five six seven"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    found = {r.doc_id: (r.line_dedup.n_copies, r.line_dedup.n_near) for r in line_dedup(spark, docs).collect()}
    assert [found[k] for k in range(len(texts))] == [
        (0, 0), (0, 1), (0, 1), (0, 0), (0, 0), (0, 0), (1, 0), (0, 0), (1, 0), (0, 0), (0, 1)]


def test_within_one_edit():
    assert within_one_edit(list("abc"), list("abc")) and within_one_edit(list("abc"), list("abd"))
    assert within_one_edit(list("abc"), list("ab")) and within_one_edit(list("bc"), list("abc"))
    assert not within_one_edit(list("abc"), list("bcd"))
    assert not within_one_edit(list("abc"), list("a"))
