"""Periodic runs against a brute-force search of every period."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from tests.llm.conftest import make
from tessera.llm.periodic_runs import periodic_runs, runs_of

SF = "/root/testdata/sf0.001"


def brute_runs(words, shortest):
    """Every period in turn: maximal stretches of equal words q apart that no smaller period has."""
    ids: dict = {}
    s = np.array([ids.setdefault(w, len(ids)) for w in words], dtype=np.int64)
    out = []
    for q in range(1, len(s) // 2 + 1):
        same = np.concatenate([[False], s[:-q] == s[q:], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        for a, b in zip(edges[0::2].tolist(), edges[1::2].tolist(), strict=True):
            if b - a + q >= max(shortest, 2 * q) and not any(
                    (s[a : b + q - p] == s[a + p : b + q]).all() for p in range(1, q)):
                out.append((a, b - a + q, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute(doc_id, text, fold, shortest):
    words = (text or "").encode().split()
    n = len(words)
    if fold and doc_id is not None and n and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words, shortest)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, n, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join("%d,%d,%d\n" % r for r in runs).encode()), sha(kept),
            [list(r) for r in runs], kept)


def plain(row):
    *rest, runs, kept = row
    return (*rest, [list(r) for r in runs], bytes(kept))


def in_order(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize("shortest", [2, 5])
def test_runs_of_small_sequences(shortest):
    rng = random.Random(shortest)
    for _ in range(600):
        k = rng.randrange(1, 4)
        s = [rng.randrange(k) for _ in range(rng.randrange(0, 30))]
        unit = [rng.randrange(k) for _ in range(rng.randrange(1, 8))]
        s += [unit[i % len(unit)] for i in range(rng.randrange(0, 30))] + s[2:9]
        ids: dict = {}
        s = [ids.setdefault(c, len(ids)) for c in s]
        got = sorted(map(tuple, runs_of(s, len(ids), shortest).tolist()), key=lambda r: (r[0], r[2]))
        assert got == brute_runs(s, shortest)


@pytest.mark.parametrize(("fold", "shortest"), [(True, 12), (False, 5)])
def test_periodic_runs(spark, hard_rows, no_docs, fold, shortest):
    rng = random.Random(11)
    rows = list(hard_rows)
    for k in range(40):  # periodic stretches among other words, also in neighbouring runs
        unit = [rng.choice("abcdefgh") for _ in range(rng.randrange(1, 30))]
        text = " ".join(rng.choice("abcdefghij") for _ in range(rng.randrange(0, 20)))
        text += "\t" + " ".join((unit * 40)[: rng.randrange(5, 200)]) + "\n" + text
        rows.append((1000 + k, text, "en", "a"))
    rows.append((1100, "tick " * 100_000, "en", "a"))
    found = [plain(r) for r in periodic_runs(spark, make(spark, rows).repartition(3), fold, shortest).collect()]
    long = [r for r in found if r[0] == 1100]
    assert [r[1:6] for r in long] == [(100_000, 1, 0, 100_000, 1)] and long[0][-1] == b"tick"
    want = [brute(i, t, fold, shortest) for i, t, _, _ in rows if i != 1100]
    assert in_order(r for r in found if r[0] != 1100) == in_order(want)
    assert sum(r[2] for r in want) > 40
    assert periodic_runs(spark, no_docs).count() == 0


def test_query_on_a_whole_table(spark):
    from tessera.llm.queries import op12_periodic_run_detection
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = in_order(tuple(r) for r in op12_periodic_run_detection(spark, SF).collect())
    want = [brute(i, t, True, 12) for i, t in rows]
    assert got == in_order((r[0], *r[2:9]) for r in want)
