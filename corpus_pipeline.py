"""The corpus pipeline: documents in, a cleaned and mixed training set out.

Stages, in order; each works on all that the one before has kept:

1. language_id: documents that it rejects go; the others get the predicted language;
2. line_dedup: lines that an earlier line makes redundant go; a document that loses all its words
   that way goes too;
3. simhash_near_dedup: of each component of near duplicates one row stays, that of the least id (a
   null id counts as the largest; of equal ids any one);
4. benchmark_decontamination: documents into which a benchmark item leaks go;
5. mixing: a sample whose expected tokens have the target shares of source, language and form.

All stages but the last return the columns of the documents they get.  Stages 3 and 4 decide by row,
by a key that they write first: rows that share an id, or have none, are documents of their own.

A stage's result reads tables that it has written; they are dropped when the next stage begins, so
each result has to be written before that, as `run` does.

**Text is never shuffled.**  Stages 3 and 4 write the documents once, in the tasks that read them,
bucketed by slice (32,768 neighbouring rows).  What an operator decides about rows comes back as one
bitmap of 4 KB a slice, joined on the slice: the bitmaps are dealt to the buckets, the documents are
read where they lie.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, materialise, n_words, shuffle_partitions
from tessera.llm.decontamination import contamination
from tessera.llm.lang_id import language_id
from tessera.llm.line_dedup import line_dedup
from tessera.llm.mixing import mix_sources, text_form
from tessera.llm.queries import MIX_FRACTION, MIX_POWERS
from tessera.llm.simhash import simhash_dedup


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


#: Rows of a slice, the bits of a bitmap.
SLICE = 32_768
_held: list[Scratch] = []


def _begin(spark: SparkSession, name: str) -> Scratch:
    """A place for a stage's tables; those of the stages before go."""
    while _held:
        old = _held.pop()
        if old.spark is spark:
            old.keep()
    _held.append(Scratch(spark, name))
    return _held[-1]


def _keyed(spark: SparkSession, docs: DataFrame, name: str) -> tuple[DataFrame, str, str]:
    """``docs`` with a key of its own for each row, written so that it stays; and the names of the
    key and of its slice, by which the table is bucketed."""
    key = "row_key"
    while any(c.lower() in (key, f"{key}_slice") for c in docs.columns):
        key += "_"
    scratch = _begin(spark, name)
    rows = docs.withColumn(key, F.monotonically_increasing_id())
    rows = rows.withColumn(f"{key}_slice", F.shiftright(key, SLICE.bit_length() - 1))
    table = f"{scratch.database}.documents"
    rows.write.bucketBy(shuffle_partitions(spark), f"{key}_slice").saveAsTable(table)
    scratch.tables.append("documents")
    return spark.table(table), key, f"{key}_slice"


def _marked(keyed: DataFrame, key: str, keys: DataFrame, how: str) -> DataFrame:
    """The rows whose keys are among ``keys`` (``how``: in) or are not (out)."""
    of = keys.select(F.shiftright("k", SLICE.bit_length() - 1).alias("slice"),
                     F.col("k").bitwiseAND(F.lit(SLICE - 1)).alias("bit"))
    maps = of.groupBy("slice").agg(F.bitmap_construct_agg("bit").alias("bits")).hint("shuffle_hash")
    bit = F.col(key).bitwiseAND(F.lit(SLICE - 1))
    byte = F.conv(F.hex(F.substring("bits", (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    is_set = F.pmod(F.floor(byte / F.pow(F.lit(2), F.pmod(bit, F.lit(8)))), F.lit(2)) == 1
    rows = keyed.join(maps, keyed[f"{key}_slice"] == maps.slice, "inner" if how == "in" else "left")
    return rows.filter(is_set if how == "in" else F.col("bits").isNull() | ~is_set)


def detect_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents whose language is found, with that language as ``lang``.

    Null, empty and letterless texts are rejected, as are texts far from every learned language; an
    empty table gives no rows; rows stand alone, so that repeats stay repeats and a text of any
    length is read whole."""
    _begin(spark, "language")
    found = language_id(spark, docs, carry=True)
    return (found.filter(~F.col("language_id.rejected"))
            .withColumn("lang", F.col("language_id.lang_pred")).select(_columns(docs)))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the lines that an earlier line makes redundant, and the documents that lose all words so.

    Null, empty and wordless texts stay as they are; an empty table gives no rows; of repeated rows
    the lines of one stay; a line of any length is compared whole.  ``n_chars`` follows the text."""
    found = line_dedup(spark, docs, scratch=_begin(spark, "line_dedup"))
    dropped = F.col("line_dedup.n_copies") + F.col("line_dedup.n_near")
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.when(dropped > 0, F.length("text").cast(
            docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    # words are counted only where lines went
    emptied = F.when(dropped > 0, n_words(F.col("text")) == 0).otherwise(False)
    return found.filter(~emptied).select(_columns(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each component of near duplicates: that of the least id (null is largest).

    Null, empty and wordless texts are one component; of repeated rows one stays; an empty table
    gives no rows; a text of any length is fingerprinted whole."""
    keyed, key, _ = _keyed(spark, docs, "near")
    found = simhash_dedup(spark, keyed, shingle=4, max_bits=4, id_col=key).select(
        F.col("doc_id").alias("found_key"), "component_id")
    ids = keyed.select(F.col(key).alias("id_key"), F.col("doc_id").alias("id"))
    first = F.min(F.struct(F.col("id").isNull(), F.col("id"), F.col("id_key")))
    stay = (found.join(ids, F.col("found_key") == F.col("id_key")).groupBy("component_id")
            .agg(first.alias("first")).select(F.col("first.id_key").alias("k")))
    stay = materialise(stay, "near-duplicates")
    return _marked(keyed, key, stay, "in").select(_columns(docs))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents into which a benchmark item leaks.

    Null and empty texts leak nothing and stay; repeated rows go or stay together; an empty table
    gives no rows, an empty benchmark drops none; a text of any length is searched whole."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    keyed, key, _ = _keyed(spark, docs, "leaks")
    gone = contamination(spark, keyed, items, id_col=key).select(F.col("doc_id").alias("k"))
    gone = materialise(gone.distinct(), "leaks")
    return _marked(keyed, key, gone, "out").select(_columns(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sample documents so that expected tokens have the target shares.

    Texts without a word, null ones too, are never drawn; rows of one id and text share a draw; an empty table gives no rows; a text of any length counts with all its words."""
    _begin(spark, "mixing")
    out = mix_sources(spark, docs, text_form(F.col("text")), MIX_POWERS, fraction=MIX_FRACTION)
    docs = docs.drop("topic", "n_tokens", "probability")  # the results take these names
    return out.select(*_columns(docs), F.col("mixing.topic").alias("topic"),
                      F.col("mixing.n_tokens").alias("n_tokens"),
                      F.col("mixing.probability").alias("probability"))


STAGES = [
    ("language_id", detect_language),
    ("line_dedup", drop_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("mixing", mix),
]
#: Edit distances, components of Hamming links and k-means are beyond SQL; the tests hold the operators
#: against brute force, and the stages against what their operators decide.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
