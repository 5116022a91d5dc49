"""Mixing sources to target weights: iterative proportional fitting, then calibrated sampling.

Documents fall into cells (source, language, topic).  Raking scales the cells' token weights to the
target share of each source, then of each language, then of each topic, again and again until all
three hold at once.  A document's probability is in proportion to its cell's raked weight over its
cell's tokens, so the expected tokens of the sample have the target shares.

Everything is DataFrame work: one aggregation of the documents to cells, rounds over the cells
(group, join, scale), and a join of the cells to the documents.
"""

from __future__ import annotations

import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import materialise, n_words

def _join(left: DataFrame, right: DataFrame, dim: str, how: str = "inner") -> DataFrame:
    """``left`` with the other columns of ``right``, matched on a dimension; nulls match nulls."""
    right = right.withColumnRenamed(dim, "right_value")
    return left.join(right, F.col(dim).eqNullSafe(F.col("right_value")), how).drop("right_value")


def target_shares(cells: DataFrame, dim: str, power: float) -> DataFrame:
    """(dim, share): token shares raised to ``power`` and made to add up to one; 1 keeps the shares
    as they are, 0 makes all values equal."""
    sums = cells.groupBy(dim).agg(F.sum("tokens").alias("tokens")).filter("tokens > 0")
    raised = sums.select(dim, F.pow(F.col("tokens").cast("double"), F.lit(power)).alias("raised"))
    total = raised.agg(F.sum("raised").alias("all"))
    return raised.crossJoin(F.broadcast(total)).select(dim, (F.col("raised") / F.col("all"))
                                                       .alias("share"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], tolerance: float = 1e-8,
         max_rounds: int = 100) -> DataFrame:
    """``cells`` (the dimensions, tokens) with a column weight whose sum over each value of each
    dimension is that value's target share.

    Values without a target get weight zero.  Stops when no marginal is off by more than
    ``tolerance`` (relative); where targets contradict the empty cells no weights meet them, and after
    ``max_rounds`` a warning names what is still off.  A round is one written table; sums are grouped with partial aggregation, so a value with many cells
    meets in no single task.
    """
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    if not total:
        return cells.withColumn("weight", F.lit(0.0))
    now = cells.withColumn("weight", F.col("tokens") / F.lit(float(total)))
    for dim, target in targets.items():
        now = _join(now, target.withColumnRenamed("share", f"share_{dim}"), dim, "left")
    now = materialise(now.fillna(0.0, [f"share_{d}" for d in targets]), "cell-targets")
    left = 0.0
    for _ in range(max_rounds):
        for dim in targets:
            sums = now.groupBy(dim).agg(F.sum("weight").alias("sum"))
            scale = F.when(F.col("sum") > 0, F.col(f"share_{dim}") / F.col("sum")).otherwise(0.0)
            now = _join(now, sums, dim).withColumn("weight", F.col("weight") * scale).drop("sum")
        now = materialise(now, "raked")
        off = [now.groupBy(dim).agg(F.sum("weight").alias("sum"), F.max(f"share_{dim}").alias("share"))
               .filter("share > 0").select(F.abs(F.col("sum") / F.col("share") - 1).alias("off"))
               for dim in targets]
        left = reduce(DataFrame.unionAll, off).agg(F.max("off")).first()[0] or 0.0
        if left <= tolerance:
            break
    if left > tolerance:
        warnings.warn(f"raking left a share off by {left:.2e} of its target", stacklevel=2)
    return now.select(*cells.columns, "weight")


def probabilities(raked: DataFrame, fraction: float | None) -> DataFrame:
    """``raked`` with the documents' probability in each cell.

    Probabilities grow until the expected tokens are ``fraction`` of all; cells that reach one stay
    there, and the rest make up for them in proportion.  A cell that cannot give its target thus costs
    no other cell a document.  Without ``fraction`` the sample is the largest that meets every target:
    the cell that is raised most is taken whole and sets the rate of all.
    """
    ratio = F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(0.0)
    cells = materialise(raked.withColumn("ratio", ratio), "cell-ratios")
    top, total = cells.agg(F.max("ratio"), F.sum("tokens")).first()
    factor = 1.0 / top if top else 0.0
    if fraction is not None and top:
        wanted, factor = fraction * float(total), 0.0
        while True:
            full = F.col("ratio") * factor >= 1
            whole, rest = cells.filter("ratio > 0").agg(
                F.sum(F.when(full, F.col("tokens")).otherwise(0)),
                F.sum(F.when(full, 0.0).otherwise(F.col("tokens") * F.col("ratio")))).first()
            new = (wanted - float(whole)) / rest if rest else factor
            if new <= factor * (1 + 1e-12):
                break
            factor = new
    return cells.withColumn("probability", F.least(F.lit(1.0), F.col("ratio") * factor))


def mix_sources(spark: SparkSession, docs: DataFrame, topic: Column,
                powers: dict[str, float] | None = None,
                targets: dict[str, DataFrame] | None = None, fraction: float | None = 0.5,
                seed: int = 0, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """The sampled documents: all columns of ``docs`` and a struct column ``mixing`` (source, lang,
    topic, n_tokens, probability; a column of that name is replaced).

    Tokens are the words ``[^\\x20\\x09-\\x0D]+``.  ``targets`` may give a (value, share) table for
    any of source, lang and topic, its value column of that name; the other dimensions aim at their
    token shares raised to ``powers`` (0.5 by default).  ``fraction``: expected tokens of the sample,
    of all (see ``probabilities``).  A document is taken if a number in [0, 1) made of the MD5 of
    seed, id and text is below its probability, so the same documents come back from every run.

    A null source, language or topic is a value of its own.  Documents without words (null and
    empty texts too) are never taken.  Rows of one id and text (no id is an id too) in one cell are
    taken or left together.  An empty table gives no rows.
    """
    docs = docs.drop("mixing")
    part = F.struct(F.col(f"`{source_col}`").alias("source"), F.col(f"`{lang_col}`").alias("lang"),
                    topic.alias("topic"), n_words(F.col(text_col)).cast("bigint").alias("n_tokens"))
    # the documents' own columns travel in one struct, so that their names clash with none here
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                         part.alias("mixing"))
    dims = ["source", "lang", "topic"]
    cells = materialise(
        marked.groupBy(*[F.col(f"mixing.{d}").alias(d) for d in dims])
        .agg(F.sum("mixing.n_tokens").alias("tokens")), "cells")
    goals = {}
    for d in dims:
        given = (targets or {}).get(d)
        if given is not None:  # values without tokens cannot be met; the rest share their part
            have = cells.groupBy(d).agg(F.sum("tokens").alias("n")).filter("n > 0")
            given = _join(given, have, d).select(d, "share")
            whole = given.agg(F.sum("share")).first()[0] or 1.0
            given = given.select(d, (F.col("share") / F.lit(float(whole))).alias("share"))
        goals[d] = materialise(given if given is not None else
                               target_shares(cells, d, (powers or {}).get(d, 0.5)), f"target-{d}")
    chance = materialise(probabilities(rake(cells, goals), fraction)
                         .select(*[F.col(d).alias(f"cell_{d}") for d in dims], "probability"),
                         "probabilities")
    same = reduce(Column.__and__, [F.col(f"mixing.{d}").eqNullSafe(F.col(f"cell_{d}"))
                                   for d in dims])
    key = F.concat(F.lit(f"{seed}:"),
                   F.coalesce(F.col(f"row.`{id_col}`").cast("string"), F.lit("")), F.lit(":"),
                   F.md5(F.coalesce(F.col(f"row.`{text_col}`"), F.lit(""))))
    draw = F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))
    return (marked.join(chance, same)
            .filter((F.col("mixing.n_tokens") > 0) & (draw < F.col("probability")))
            .select(*[F.col(f"row.`{c}`") for c in docs.columns],
                    F.col("mixing").withField("probability", F.col("probability"))
                    .alias("mixing")))


def text_form(text: Column) -> Column:
    """A topic for tables that have none: the form of the text."""
    n = F.length(text)
    return (F.when(F.contains(text, F.lit(" | ")), "table").when(n < 500, "short")
            .when(n < 5000, "medium").otherwise("long"))
