from __future__ import annotations

import random

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, block long, "
          "fp string, mixing int, line_dedup int, language_id int, bucket string, extra string")


def make(spark, rows):
    """Documents from (doc_id, text, lang, source), with extra columns whose names clash."""
    return spark.createDataFrame(
        [(i, t, lang, src, None if t is None else len(t), 7, "x", 1, 2, 3, None, "e")
         for i, t, lang, src in rows], SCHEMA)


def prose(rng, n, words):
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.fixture(scope="session")
def hard_rows():
    """Nulls, empties, ties, copies, near copies, shared passages, a very long text."""
    rng = random.Random(5)
    words = ["".join(rng.choice(["an", "be", "co", "dé", "Er", "fu", "ß", "gi"])
                     for _ in range(rng.randint(1, 4))) for _ in range(3000)]
    passage = prose(rng, 70, words)
    base = ["\n".join(prose(rng, rng.randint(1, 60), words) for _ in range(rng.randint(1, 8)))
            for _ in range(40)]
    rows = [(k, t, rng.choice(["en", "de", None]), rng.choice(["a", "b", None]))
            for k, t in enumerate(base)]
    n = len(rows)
    rows += [(n + k, base[k % 5], "en", "a") for k in range(20)]  # copies
    for k in range(20):  # near copies
        w = base[6].split(" ")
        w[rng.randrange(len(w))] = rng.choice(words)
        rows.append((n + 20 + k, " ".join(w), "de", "b"))
    rows += [(n + 40 + k, prose(rng, 20, words) + " " + passage + "\n" + prose(rng, 9, words),
              "en", None) for k in range(6)]
    rows += [(200, None, "en", "a"), (201, "", None, "a"), (202, " \n\t ", "en", None),
             (203, "1234 !!", "en", "a"), (204, "é", "de", "b"), (205, "ab " * 400, "en", "a"),
             (206, "a" * 1500, "en", "a"), (207, "x", "en", "a"), (208, "日本語 テキスト", None, "a"),
             (209, prose(rng, 30000, words), "en", "a"), (None, base[3], "en", "a"),
             (None, None, None, None), (210, base[8], "en", "a"), (210, base[8], "en", "a"),
             (211, "tail\r\nline\x0bend\x85of " + base[9], "en", "a")]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def hard_docs(spark, hard_rows):
    return make(spark, hard_rows).repartition(4)


@pytest.fixture(scope="session")
def no_docs(spark):
    return make(spark, [])
