"""The pipeline on awkward documents, and on a small table against its operators' rules."""

from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.conftest import make
from tessera.llm.queries import oracle_sql, registry

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_survive_odd_rows(spark, hard_docs, no_docs):
    names = ("topic", "n_tokens", "probability", "gone_id", "dropped")
    for docs in (hard_docs.withColumns({c: F.lit("clash") for c in names}), no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns
            docs = spark.createDataFrame(out.collect(), out.schema)
        out = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
        assert len(set(out.columns)) == len(out.columns) and set(docs.columns) <= set(out.columns)
        assert all(0 < r.probability <= 1 for r in out.collect())


def test_run_drops_what_it_should(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, docs, SF).collect()
        docs = spark.createDataFrame(rows, docs.schema)
    kept = {r.doc_id: r.text for r in rows}
    assert not any(item in text for text in kept.values() for item in items)
    assert len(set(kept.values())) == len(kept)
    # a document that shares nothing loses nothing
    assert all(len(kept[i]) <= len(texts[i]) for i in kept)
    assert len(kept) > 0.8 * len(set(texts.values()))
    out = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in out} <= set(kept) and all(0 < r.probability <= 1 for r in out)


def test_rows_without_ids_of_their_own(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    copy, clean, other = ("one two three four five six", "seven eight nine ten eleven twelve",
                          "red green blue cyan pink teal")
    rows = [(None, copy, "en", "a"), (5, copy, "en", "b"), (5, copy, "en", "c"), (5, clean, "en", "a"),
            (5, f"x {item} y", "en", "a"), (None, f"z {item} z", "en", "a"), (None, other, "en", "a")]
    docs = make(spark, rows).withColumn("row_key", F.lit("clash"))
    out = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    assert out.columns == docs.columns
    got = [(r.doc_id, r.text) for r in out.collect()]
    assert [g for g in got if g[1] == copy] == [(5, copy)]
    assert {(5, clean), (None, other)} <= set(got)
    out = corpus_pipeline.drop_contaminated(spark, docs, SF)
    assert sorted(r.text for r in out.collect()) == sorted([copy] * 3 + [clean, other])
    assert out.columns == docs.columns


def test_every_operator_is_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in registry())
    assert numbers == list(range(1, len(numbers) + 1)) and set(oracle_sql()) <= set(registry())


def test_marked_rows_are_those_of_the_keys(spark):
    docs = spark.range(100_000).selectExpr("id AS doc_id", "string(id) AS text", "1 AS row_key", "2 AS row_key__slice")
    keyed, key, part = corpus_pipeline._keyed(spark, docs.repartition(3), "marked")
    rows = keyed.select(key, "doc_id").collect()
    assert len({r[0] for r in rows}) == 100_000
    for chosen in ([], [r[0] for r in rows if r[1] % 7 == 0], [r[0] for r in rows]):
        keys = spark.createDataFrame([(k,) for k in chosen], "k long")
        among = set(chosen)
        ids = {r[1] for r in rows if r[0] in among}
        got = [r.doc_id for r in corpus_pipeline._marked(keyed, key, keys, "in").select("doc_id").collect()]
        assert len(got) == len(ids) and set(got) == ids
        rest = [r.doc_id for r in corpus_pipeline._marked(keyed, key, keys, "out").select("doc_id").collect()]
        assert len(rest) == 100_000 - len(ids) and not set(rest) & ids


def test_documents_are_not_shuffled(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        for stage in (corpus_pipeline.drop_near_duplicates, corpus_pipeline.drop_contaminated):
            p = stage(spark, docs, SF)._jdf.queryExecution().executedPlan().toString()
            scan = p.index(".documents[")
            above = [x for x in p[:scan].split("\n") if "Exchange" in x or "Sort" in x]
            assert "ShuffledHashJoin" in p and not above, p
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
