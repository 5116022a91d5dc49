"""Language ID, quality rules, LM scoring, decontamination, mixing, chat: held-out or brute force."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import make
from tessera.llm.blocks import key_buckets, pack, split_by_bucket, unpack
from tessera.llm.chat_formatting import preference_pairs, swapped_replies
from tessera.llm.decontamination import Index, Words, bound, contamination, nearest
from tessera.llm.lang_id import counts, fit, language_id, spherical_kmeans
from tessera.llm.lm_scoring import lm_scores
from tessera.llm.mixing import mix_sources, rake
from tessera.llm.quality import RULES, ordered, quality_cascade
from tessera.llm.texts import Texts

SF = "/root/testdata/sf0.01"


def test_language_id_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = language_id(spark, docs).join(docs, "doc_id").toPandas()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()
    held = got[got.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.97
    assert got.score.between(0, 1).all() and got.rejected.mean() < 0.01


def test_language_id_rejects_by_distance(spark):
    rng = random.Random(2)
    noise = [" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9)))
                      for _ in range(500)) for _ in range(100)]
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source")
    odd = spark.createDataFrame([(10**6 + k, t, None, "noise") for k, t in enumerate(noise)], docs.schema)
    got = language_id(spark, docs.unionAll(odd)).toPandas()
    far = got.doc_id >= 10**6
    assert got[far].rejected.mean() > 0.95
    assert got[~far & got.held_out].rejected.mean() <= 0.01


def test_small_clusters_are_merged():
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(at, 0.1, (60, 8)) for at in np.eye(8)[:2]] + [np.eye(8)[7:]])
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    for seed in range(10):
        centroids = spherical_kmeans(x, 3, seed=seed)
        size = np.bincount((x @ centroids.T).argmax(axis=1))
        assert size.min() >= 12 and np.linalg.norm(centroids, axis=1) == pytest.approx(1)
    assert len(spherical_kmeans(x[:1], 3)) == 1 and len(spherical_kmeans(x[[0, 0, 0]], 3)) == 1


def test_language_id_model_does_not_depend_on_the_sample(spark):
    words = {"xa": "lorem ipsum dolor sit amet consectetur elit".split(), "xb": "ein kleiner Hund lief durch den Wald".split()}
    rows = [(i, " ".join(words[lang][(i * k + k) % 7] for k in range(1, 4 + i % 9)), lang)
            for i, lang in enumerate(["xa", "xb"] * 100)]
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    few, all_ = (fit(spark, train, 1024, 1, n, "doc_id", "text", "lang") for n in (2, 1000))
    assert few[0] == all_[0] == ["xa", "xb"]
    for a, b in zip(few[1:], all_[1:]):
        assert np.array_equal(a, b)


def test_language_id_odd_texts(spark, hard_rows, hard_docs, no_docs):
    rows = language_id(spark, hard_docs).collect()
    assert len(rows) == len(hard_rows)
    got = {r.doc_id: r for r in rows}
    for k in (200, 201, 202, 203):
        assert (got[k].lang_pred, got[k].score, got[k].rejected) == ("und", 0.0, True)
    assert got[208].lang_pred in ("en", "de") and got[209].lang_pred in ("en", "de")
    carried = language_id(spark, hard_docs, carry=True)
    assert carried.columns == [*hard_docs.drop("language_id").columns, "language_id"]
    assert {(r.doc_id, r.text) for r in carried.collect()} == {(r[0], r[1]) for r in hard_rows}
    assert language_id(spark, no_docs).count() == 0
    unlabelled = make(spark, [(1, "some text", None, "a")])
    assert language_id(spark, unlabelled).first().lang_pred == "und"


def test_trigrams_stay_within_their_text():
    texts = [b"", b"ab", b"  .", b"cd e. ", b"x", b" -y", b"", "日本".encode()]
    together = [row for _, block in counts(Texts(texts), 512) for row in block]
    for text, row in zip(texts, together, strict=True):
        (alone,) = next(counts(Texts([text]), 512))[1]
        assert (row == alone).all(), text


def test_quality_order_never_changes_the_verdict(spark, hard_rows, hard_docs, no_docs):
    rows = quality_cascade(spark, hard_docs, report=True).collect()
    assert len(rows) == len(hard_rows)
    plain = quality_cascade(spark, hard_docs, tuple(reversed(RULES))).collect()
    assert Counter((r.doc_id, r.kept) for r in rows) == Counter((r.doc_id, r.kept) for r in plain)
    got = {r.doc_id: r for r in rows}
    for k in (200, 201, 202, 205, 207):
        assert got[k].base_failed and not got[k].kept
    assert (got[200].n_words, got[205].n_words, got[205].n_repeat_words) == (0, 400, 400)
    assert got[209].kept
    assert quality_cascade(spark, no_docs).count() == 0


def test_rules_are_ordered_by_rejection_per_cost():
    names = [r.name for r in RULES[:3]]
    plan = ordered(RULES[:3], [(names[0], 1.0, 0.1), (names[1], 0.1, 0.1), (names[2], 1.0, 0.9)])
    assert [r.name for r in plan] == [names[1], names[2], names[0]]


def test_lm_scores(spark, hard_rows, hard_docs, no_docs):
    texts = [(i, [*(t or "").encode().lower().split(), None]) for i, t, _, _ in hard_rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in texts]
    share, d = 2e-3, 0.75
    c = [Counter() for _ in range(4)]
    for (_, w), out in zip(texts, held, strict=True):
        for n in (1, 2, 3):
            c[n].update(tuple(w[k : k + n]) for k in range(len(w) - n + 1) if not out)
    total, types = sum(c[1].values()), len(c[1])
    states = {h for h, x in c[1].items() if x >= share * total and h[0] is not None}
    states |= {h for h, x in c[2].items() if x >= max(2, share * total) and h[1] is not None
               and h[:1] in states}
    kept = {g: x for n in (2, 3) for g, x in c[n].items() if x >= 2 and g[:-1] in states}
    left = Counter()
    for g, x in kept.items():
        left[g[:-1]] += x - d

    def p(w, h):
        if not h:
            return (c[1][(w,)] + 0.5) / (total + 0.5 * (types + 1))
        if h not in states:
            return p(w, h[1:])
        n = c[len(h)][h]
        return max(kept.get((*h, w), 0) - d, 0) / n + (1 - left[h] / n) * p(w, h[1:])

    want = {}
    for i, w in texts:
        want[i, len(w)] = (sum(c[1][(x,)] > 0 for x in w), sum(math.log10(p(x, ())) for x in w),
                           sum(math.log10(p(x, tuple(w[max(0, k - 2) : k])))
                               for k, x in enumerate(w)))
    rows = lm_scores(spark, hard_docs, state_share=share).collect()
    assert len(rows) == len(texts) and any(len(h) == 2 for h in states)
    for r in rows:
        known, base, score = want[r.doc_id, r.n_tokens]
        assert (r.n_known, r.train_tokens) == (known, total)
        assert r.base_score == pytest.approx(base) and r.score == pytest.approx(score)
    assert lm_scores(spark, no_docs).count() == 0
    alone = make(spark, [(1, "a b", None, None)])  # trains or not, the floor scores it
    assert lm_scores(spark, alone).first().n_tokens == 3


def test_lm_scores_use_every_kept_history(spark, hard_rows, hard_docs):
    texts = [(i, [*(t or "").encode().lower().split(), None]) for i, t, _, _ in hard_rows]
    c = [Counter() for _ in range(4)]
    for i, w in texts:
        if i is None or zlib.crc32(str(i).encode()) % 5 != 1:
            for n in (1, 2, 3):
                c[n].update(tuple(w[k : k + n]) for k in range(len(w) - n + 1))
    total, types = sum(c[1].values()), len(c[1])
    left = Counter()
    for n in (2, 3):
        for g, x in c[n].items():
            if x >= 2:
                left[g[:-1]] += x - 0.75

    def p(w, h):
        if not h:
            return (c[1][(w,)] + 0.5) / (total + 0.5 * (types + 1))
        n = c[len(h)][h]
        if n < len(h):  # no training count, or a pair that is not kept
            return p(w, h[1:])
        x = c[len(h) + 1][(*h, w)]
        return (x - 0.75 if x >= 2 else 0) / n + (1 - left[h] / n) * p(w, h[1:])

    want = {(i, len(w)): sum(math.log10(p(x, tuple(w[max(0, k - 2) : k]))) for k, x in enumerate(w))
            for i, w in texts}
    assert sum(x > 1 for x in c[2].values()) > 1000  # the old bound: a thousand states an order
    for r in lm_scores(spark, hard_docs).collect():
        assert r.score == pytest.approx(want[r.doc_id, r.n_tokens])


def test_packed_arrays():
    rng = np.random.default_rng(1)
    keys = np.sort(rng.integers(0, 1 << 64, 1000, dtype=np.uint64))
    keys[-1] = np.uint64((1 << 64) - 1)
    assert (unpack(pack(keys, True), "u8", True) == keys).all()
    counts_ = rng.geometric(0.5, 1000).astype(np.uint32)
    assert (unpack(pack(counts_), "u4") == counts_).all() and len(pack(counts_)) < 600
    assert len(unpack(pack(keys[:0], True), "u8", True)) == 0
    for n in (1, 3, 240_000, 2**31 - 1):
        assert key_buckets(keys, n).tolist() == [int(k) * n >> 64 for k in keys.tolist()]
        rows = split_by_bucket(7, keys, None, counts_, n, packed=True)
        assert rows.num_rows == len(set(key_buckets(keys, n)))
        back = [unpack(k, "u8", True) for k in rows.column("keys").to_pylist()]
        assert (np.concatenate(back) == keys).all()


def test_contamination_recall_with_edits(spark, no_docs):
    rng = random.Random(1)
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    words = spark.read.parquet(f"{SF}/documents.parquet").limit(50).toPandas().text.str.cat().split()
    index = Index([i for i, _ in items], [t.encode() for _, t in items], 0.2, 2, 0.98, 5)
    hashes = dict(index.items)
    found = tried = 0
    for _ in range(150):
        item, text = rng.choice(items)
        w = text.split()
        for _ in range(bound(len(hashes[item]), 0.2)):
            k, how = rng.randrange(len(w)), rng.random()
            w[k : k + (how < 0.67)] = [rng.choice(words)] if how > 0.33 else []
        doc = Words([" ".join(rng.choices(words, k=80) + w + rng.choices(words, k=80)).encode()])
        if nearest(hashes[item], doc.hash)[0] <= bound(len(hashes[item]), 0.2):
            tried += 1
            found += any(leak[1] == item for leak in index.leaks(doc))
    assert tried > 60 and found / tried >= 0.95


@pytest.mark.parametrize("how", ["deletions", "insertions"])
@pytest.mark.parametrize("n", [100, 200, 500])
def test_contamination_recall_of_long_items(n, how):
    rng = random.Random(n)
    items = [[f"w{rng.randrange(10**9)}" for _ in range(n)] for _ in range(40)]
    index = Index(list(range(40)), [" ".join(w).encode() for w in items], 0.2, 2, 0.98, 5)
    found = 0
    for k, w in enumerate(items):
        w = list(w)
        for _ in range(bound(n, 0.2)):
            if how == "deletions":
                del w[rng.randrange(len(w))]
            else:
                w.insert(rng.randrange(1, len(w)), f"n{rng.random()}")
        around = [f"p{rng.random()}" for _ in range(300)]
        doc = Words([" ".join(around[:150] + w + around[150:]).encode()])
        found += any(leak[1] == k for leak in index.leaks(doc))
    assert found >= 39


def test_contamination_odd_tables(spark, hard_docs, no_docs):
    bench = spark.createDataFrame(
        [(1, "Alpha, beta gamma delta epsilon zeta!"), (2, None), (3, ""), (4, "too short"),
         (None, "one two three four five six seven"),
         (1, "Alpha, beta gamma delta epsilon zeta!")], "item_id long, text string")
    docs = make(spark, [(1, "x alpha BETA gamma\ndelta epsilon zeta y", None, None),
                        (2, "alpha beta gamma delta epsilon", None, None), (3, None, None, None),
                        (None, "one two three four five six seven", None, None),
                        (5, "alpha beta", None, None)])
    rows = contamination(spark, docs, bench).collect()
    assert {(r.doc_id, r.item_id, r.distance) for r in rows} == {(1, 1, 0), (2, 1, 1), (None, None, 0)}
    assert {r.found for r in rows if r.doc_id == 1} == {"alpha beta gamma delta epsilon zeta"}
    assert contamination(spark, no_docs, bench).count() == 0
    assert contamination(spark, docs, bench.limit(0)).count() == 0
    contamination(spark, hard_docs, bench).count()


def test_rake_meets_every_marginal(spark):
    cells = spark.createDataFrame(
        [(s, la, t, (k * 37) % 11 * 10 + 5) for k, (s, la, t) in enumerate(
            (s, la, t) for s in ("a", "b", None) for la in ("x", "y") for t in (1, 2))],
        "source string, lang string, topic int, tokens long")
    goal = {"source": spark.createDataFrame([("a", 0.5), ("b", 0.2), (None, 0.3)],
                                            "source string, share double"),
            "lang": spark.createDataFrame([("x", 0.9), ("y", 0.1)], "lang string, share double"),
            "topic": spark.createDataFrame([(1, 0.4), (2, 0.6)], "topic int, share double")}
    out = rake(cells, goal).toPandas()
    for dim, target in goal.items():
        sums = out.groupby(dim, dropna=False).weight.sum()
        for value, share in target.collect():
            hit = sums[sums.index.isna()] if value is None else sums[[value]]
            assert hit.iloc[0] == pytest.approx(share, abs=1e-7)


def test_a_tiny_source_costs_no_other_document(spark):
    rows = [(k, f"w{k} " * 40, "en", "ab"[k % 2]) for k in range(2000)]
    tokens = lambda docs: (mix_sources(spark, make(spark, docs), F.lit("t"))
                           .agg(F.sum("mixing.n_tokens")).first()[0])
    before, after = tokens(rows), tokens([*rows, (2000, "just six words of a source", "en", "c")])
    assert before / 80_000 == pytest.approx(0.5, abs=0.05) and abs(after - before) <= 200


def test_rows_without_ids_are_drawn_one_by_one(spark):
    rows = [(None, f"w{k} x y", "en", "a") for k in range(400)]
    assert 150 < mix_sources(spark, make(spark, rows), F.lit("t")).count() < 250


def test_targets_that_cannot_be_met_are_named(spark):
    cells = spark.createDataFrame([("a", "x", 5), ("b", "y", 5)], "source string, lang string, tokens long")
    goal = {"source": spark.createDataFrame([("a", 0.9), ("b", 0.1)], "source string, share double"),
            "lang": spark.createDataFrame([("x", 0.1), ("y", 0.9)], "lang string, share double")}
    with pytest.warns(UserWarning, match="off by"):
        rake(cells, goal, max_rounds=3)


def test_mix_sources_odd_tables(spark, hard_rows, hard_docs, no_docs):
    topic = F.lit("t")
    clash = {c: F.lit("clash") for c in ("cell_source", "topic", "probability", "n_tokens", "row",
                                         "right_value")}
    out = mix_sources(spark, hard_docs.withColumns(clash), topic, seed=3)
    assert out.columns == [*hard_docs.drop("mixing").columns, *clash, "mixing"]
    rows = out.collect()
    assert 0 < len(rows) < len(hard_rows) and all(r.mixing.n_tokens > 0 for r in rows)
    again = mix_sources(spark, hard_docs.repartition(7), topic, seed=3).collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((r.doc_id, r.text) for r in again)
    assert mix_sources(spark, no_docs, topic).count() == 0
    assert mix_sources(spark, make(spark, [(1, None, "en", "a")]), topic).count() == 0
    whole = mix_sources(spark, hard_docs, topic, fraction=1.0).collect()
    assert all(r.mixing.probability == pytest.approx(1) for r in whole)


def test_preference_pairs(spark):
    schema = "pair_id long, turn long, role string, text string, prompt string"
    c = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (1, 2, "user", "more"),
         (2, 0, "user", "a"), (2, 1, "assistant", "b"), (3, 0, None, None), (4, 0, "user", "alone"),
         (None, 0, "user", "x"), (5, 0, "assistant", "p"), (5, 0, "assistant", "p")]
    r = [(1, 0, "user", "hi"), (1, 1, "assistant", "no"), (2, 0, "user", "a"),
         (2, 1, "assistant", "b"), (3, 0, "", ""), (5, 0, "assistant", "q"), (None, 0, "user", "x")]
    frame = lambda rows: spark.createDataFrame([(*x, "clash") for x in rows], schema)
    got = {x.pair_id: x for x in preference_pairs(spark, frame(c), frame(r)).collect()}
    assert set(got) == {1, 2, 3, 5}
    one = got[1]
    assert one.prompt == "<|user|>\nhi<|end|>\n" and one.n_prompt_turns == 1 and one.usable
    (span,) = one.chosen_train
    assert one.chosen[span.start : span.end] == "yes<|end|>"
    assert one.rejected[one.rejected_train[0].start : one.rejected_train[0].end] == "no<|end|>"
    assert got[2].chosen == got[2].rejected == "" and not got[2].usable
    assert got[3].n_prompt_turns == 1 and len(got[5].chosen_train) == 2
    assert preference_pairs(spark, frame([]), frame(r)).count() == 0


def test_swapped_replies_with_odd_columns(spark):
    rows = [(2, 0, "user", "a"), (2, 1, "assistant", "b"), (3, 0, "assistant", "c"),
            (9, 0, "assistant", "d"), (None, 0, "assistant", "e"), (4, 0, "user", None)]
    turns = spark.createDataFrame([(*r, 8, "x") for r in rows],
                                  "conv_id long, turn long, role string, text string, "
                                  "last_turn int, reply string")
    got = {(r.conv_id, r.turn): r.text for r in swapped_replies(turns).collect()}
    assert got == {(2, 0): "a", (2, 1): "c", (3, 0): "b", (9, 0): "", (None, 0): "e", (4, 0): None}


def test_blocks_of_lm_hold_tokens_not_texts(spark, monkeypatch):
    from tessera.llm import lm_scoring
    from tessera.llm.blocks import read_block

    texts = ["A b a", None, "", " \n", "b\tÄ a", "c"]
    made = []

    class Watched(lm_scoring.Blocks):
        def __init__(self, *args, **kw):
            super().__init__(*args, **kw)
            made.append(self)

    monkeypatch.setattr(lm_scoring, "Blocks", Watched)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    n_tokens = {r.doc_id: r.n_tokens for r in lm_scores(spark, docs).collect()}
    assert n_tokens == {i: len((t or "").split()) + 1 for i, t in enumerate(texts)}
    block = read_block(made[0].table.toArrow(), 0)
    assert b"A b a" not in block.data.tobytes() and b"a b a" not in block.data.tobytes()
    tokens = lm_scoring._Tokens(block, lm_scoring.Model(5, 1, 0.75, 2, 0.0))
    want = [w for t in texts for w in [*(t or "").encode().lower().split(), None]]
    assert len(tokens.keys) == len(set(want)) and (np.diff(tokens.keys) > 0).all()
    number = {}
    assert all(number.setdefault(w, k) == k for w, k in zip(want, tokens.word.tolist(), strict=True))


def test_stable_order():
    from tessera.llm.blocks import stable_order

    rng = np.random.default_rng(3)
    top = np.uint64((1 << 64) - 1)
    for keys in (rng.integers(0, 1 << 64, 5000, dtype=np.uint64), rng.integers(0, 50, 5000, dtype=np.uint64),
                 top - rng.integers(0, 50, 5000, dtype=np.uint64),  # differ in the last bits alone
                 np.repeat(rng.integers(0, 1 << 64, 100, dtype=np.uint64), 40)[rng.permutation(4000)],
                 np.array([top]), np.empty(0, dtype=np.uint64)):
        assert (stable_order(keys) == np.argsort(keys, kind="stable")).all()
