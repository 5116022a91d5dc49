"""Queries of this subpackage: each applies an operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.chat_formatting import preference_pairs, swapped_replies
from tessera.llm.common import new_path
from tessera.llm.decontamination import contamination
from tessera.llm.lang_id import language_id
from tessera.llm.line_dedup import line_dedup
from tessera.llm.lm_scoring import lm_scores
from tessera.llm.mixing import mix_sources, text_form
from tessera.llm.oracle import CHAT_SQL, QUALITY_SQL, TRIE_SQL, WARC_SQL, mixing_sql
from tessera.llm.periodic_runs import periodic_runs
from tessera.llm.prefix_trie import prefix_trie
from tessera.llm.quality import quality_cascade
from tessera.llm.simhash import simhash_dedup
from tessera.llm.substring_dedup import substring_dedup
from tessera.llm.suffix_dedup import suffix_dedup
from tessera.llm.warc import read_warc, resolve_revisits, write_warc


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup(spark, _documents(spark, sf_dir)).drop("fp")


#: Token shares are flattened by these powers (1 keeps them).
MIX_POWERS = {"source": 0.5, "lang": 0.7, "topic": 0.8}
#: Expected tokens of the sample, of all.
MIX_FRACTION = 0.5


def op2_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sampled documents: doc_id, cell, tokens and probability (six digits)."""
    out = mix_sources(spark, _documents(spark, sf_dir), text_form(F.col("text")), MIX_POWERS,
                      fraction=MIX_FRACTION)
    return out.select("doc_id", "mixing.source", "mixing.lang", "mixing.topic", "mixing.n_tokens",
                      F.round("mixing.probability", 6).alias("probability"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(spark, _documents(spark, sf_dir)).drop("removed")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(spark, _documents(spark, sf_dir))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_copies, n_near and the digest of the text left."""
    return line_dedup(spark, _documents(spark, sf_dir)).select("doc_id", "line_dedup.*")


def _spans(col: str) -> Column:
    return F.array_join(F.transform(col, lambda s: F.concat_ws("-", s.start, s.end)), ",")


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of each conversation with the same one under its neighbour's last reply."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    pairs = preference_pairs(spark, turns, swapped_replies(turns), "conv_id")
    return pairs.withColumns({c: _spans(c) for c in ("chosen_train", "rejected_train")}
                             ).withColumnRenamed("pair_id", "conv_id")


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(spark, _documents(spark, sf_dir),
                         spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_cascade(spark, _documents(spark, sf_dir), report=True)


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(spark, _documents(spark, sf_dir)).drop("removed")


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(spark, _documents(spark, sf_dir))


def op11_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trie of the conversations, rebuilt in families of 20 that share up to 3 opening turns."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return prefix_trie(spark, turns, family=20, most=3).drop("enter", "exit")


def op12_periodic_run_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(spark, _documents(spark, sf_dir), fold=True).drop("n_words", "runs", "collapsed")


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages, written as archives and read back; a record that fails a check ends the query."""
    archive = new_path(spark, "warc")
    write_warc(spark, spark.read.parquet(f"{sf_dir}/pages.parquet"), archive)
    records = resolve_revisits(read_warc(spark, archive, payloads=False))
    right = F.when(F.col("problem").isNull(), F.col("kind")).otherwise(F.raise_error(F.concat(
        F.lit("record "), F.coalesce("record", F.lit("?")), F.lit(": "), F.col("problem"))))
    return records.select(F.col("doc_id").alias("page_id"), "payload_bytes",
                          F.col("payload_sha1").alias("payload_digest"), right.alias("record_type"), "refers_to")


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_simhash_near_dedup, op2_mixing_sources, op3_substring_dedup, op4_language_id,
        op5_line_dedup, op6_chat_formatting, op7_benchmark_decontamination, op8_quality_rules,
        op9_suffix_array_dedup, op10_lm_scoring,
        op11_conversation_prefix_trie, op12_periodic_run_detection, op13_warc)}


def oracle_sql() -> dict[str, str]:
    return {"op2_mixing_sources": mixing_sql(MIX_POWERS, MIX_FRACTION), "op6_chat_formatting": CHAT_SQL,
            "op8_quality_rules": QUALITY_SQL, "op11_conversation_prefix_trie": TRIE_SQL,
            "op13_warc": WARC_SQL}
