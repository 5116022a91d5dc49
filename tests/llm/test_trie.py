"""Prefix trie against a brute-force trie; list ranking against a walk."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tessera.llm.common import Scratch
from tessera.llm.prefix_trie import prefix_trie
from tessera.llm.ranking import list_rank

SCHEMA = "conv_id long, turn long, role string, text string, depth int, parent string, key string"


def brute(rows, family=None, most=3):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % (most + 1) if family else 0
        base = c - (abs(c) % family * (1 if c >= 0 else -1)) if family else c
        built[c] = own.get(base, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in sorted(built.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    out = []
    for node, convs in members.items():
        below = [n for n in members if n[: len(node)] == node]
        ends = ",".join(str(c) for c in convs if len(built[c]) == len(node))
        out.append((convs[0], len(node), members[node[:-1]][0] if node else None, len(convs),
                    len(children[node]), sum(not children[n] for n in below),
                    sum((len(members[n]) - 1) * len(n[-1][1].encode().split()) for n in below if n),
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 9, "p", "k") for r in rows], SCHEMA)


def got(df):
    return sorted((tuple(r) for r in df.drop("enter", "exit").collect()), key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    texts = ["", None, "a b", "a  b\tc", "ü\x85x", "x" * 100_000 + " y", "hello there"]
    out = []
    for c in [*range(0, 45), 100, 119, -3, -20]:
        if c == 20:  # its family has no first conversation
            continue
        for t in range(rng.randrange(1, 6)):
            out.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(texts[:4])))
    out += [(200 + k, t, "user", f"copy {t}") for k in range(30) for t in range(3)]   # copies
    out += [(300, t, "user", f"long {t % 7}") for t in range(400)]                    # a hot conversation
    out += [(301, t, "user", f"long {t % 7}") for t in range(250)]
    out += [(302, None, "user", "same")] * 20 + [(302, None, None, None), (302, 5, "user", texts[5])]
    out += [(303, 1, "b", "tie"), (303, 1, "a", "tie"), (None, 1, "user", "nobody")]
    out += [(304, 1, "user", texts[4]), (305, 1, "use", "r" + texts[4])]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("sizes", [{}, {"cell": 5, "bucket": 7, "tail": 6}])
def test_trie(spark, rows, sizes):
    # families end at 200: each conversation above is its family's own
    few = [r for r in rows if r[0] not in (301,)] if not sizes else rows
    out = prefix_trie(spark, frame(spark, few).repartition(3), **sizes)
    assert got(out) == brute(few)
    spans = sorted((r["enter"], r["exit"]) for r in out.collect())
    assert sorted(x for s in spans for x in s) == list(range(2 * len(spans)))


def test_families(spark, rows):
    few = [r for r in rows if r[0] is not None and r[0] < 240]
    out = prefix_trie(spark, frame(spark, few), family=20)
    assert got(out) == brute(few, family=20)


def test_no_conversations(spark):
    assert prefix_trie(spark, frame(spark, [])).count() == 0
    assert prefix_trie(spark, frame(spark, [(None, 1, "user", "x")]), family=20).count() == 0


@pytest.mark.parametrize("n", [0, 1, 300])
def test_list_rank(spark, n):
    rng = random.Random(n)
    ids = rng.sample(range(-10_000, 10_000), n)
    cut = n // 3  # two lists
    lens = [rng.randrange(1, 5) for _ in ids]
    links = [(i, ids[k + 1] if k + 1 not in (cut, n) else None, lens[k]) for k, i in enumerate(ids)]
    want = [(i, sum(lens[(0 if k < cut else cut):k])) for k, i in enumerate(ids)]
    df = spark.createDataFrame(links, "id long, next long, len long")
    starts = list_rank(Scratch(spark, "rank"), df, tail=20)
    assert sorted(map(tuple, starts.collect())) == sorted(want)
