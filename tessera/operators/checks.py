"""Declarative data-quality checks and the publication gate.

Each ``check_*`` returns the failing rows, like an assertion query: a check
passes when its result is empty.  ``run_checks`` evaluates a catalogue of
specs into one summary frame (one row per check, ``failures`` = rows the
assertion returns) and ``enforce`` raises when any check failed.

Scale notes: every check is an aggregation with map-side combine, so a hot
value costs one row per map task; ``relationships`` anti-joins the *distinct*
child keys (with their row counts) against the parent keys, so a child key
repeated a billion times is one row on the join.  ``run_checks`` evaluates a
whole catalogue, one query per model, and shuffles of a value what its check
needs, if the table does not lie by it already (see below).
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.keys import packed_key
from tessera.session import dropping_shuffles

SUMMARY_COLUMNS = ["check_id", "model", "test", "column_name", "failures"]


class DataQualityError(RuntimeError):
    pass


@dataclass(frozen=True)
class CheckSpec:
    model: str
    test: str                       # unique | not_null | relationships | unique_combination
    columns: tuple[str, ...]
    to: str | None = None           # relationships: parent model
    field: str | None = None        # relationships: parent column
    where: str | None = None        # scope filter applied first

    @property
    def column_name(self) -> str:
        return ",".join(self.columns)

    @property
    def check_id(self) -> str:
        parts = [self.test, self.model, "__".join(self.columns)]
        if self.to:
            parts += ["to", self.to, self.field or ""]
        if self.where:
            parts += ["where", self.where.replace(" ", "_")]
        return "__".join(parts)


def _scoped(df: DataFrame, where: str | None) -> DataFrame:
    return df.filter(F.expr(where)) if where else df


# ---------------------------------------------------------------------------
# row-level checks (the failing rows)
# ---------------------------------------------------------------------------
def check_unique(df: DataFrame, col: str, where: str | None = None) -> DataFrame:
    """Duplicated non-NULL values of ``col`` with their row counts."""
    d = _scoped(df, where).filter(F.col(col).isNotNull())
    return (d.groupBy(col).agg(F.count(F.lit(1)).alias("n_records"))
             .filter(F.col("n_records") > 1))


def check_not_null(df: DataFrame, col: str, where: str | None = None) -> DataFrame:
    """Rows where ``col`` is NULL."""
    return _scoped(df, where).filter(F.col(col).isNull())


def check_relationships(child: DataFrame, col: str, parent: DataFrame, field: str,
                        where: str | None = None) -> DataFrame:
    """Child keys (non-NULL) absent from ``parent.field``, with row counts."""
    keys = (_scoped(child, where).filter(F.col(col).isNotNull())
            .groupBy(col).agg(F.count(F.lit(1)).alias("n_records")))
    parents = parent.select(F.col(field).alias(col)).filter(F.col(col).isNotNull())
    return keys.join(parents, on=col, how="left_anti")


def check_unique_combination(df: DataFrame, cols: Sequence[str],
                             where: str | None = None) -> DataFrame:
    """Duplicated combinations of ``cols`` with their row counts."""
    return (_scoped(df, where).groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records"))
            .filter(F.col("n_records") > 1))


def null_counts(df: DataFrame, cols: Sequence[str], where: str | None = None) -> DataFrame:
    """NULL count of every column in one pass: (column_name, failures)."""
    agg = _scoped(df, where).agg(*[
        F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)])
    pairs = ", ".join(f"'{c}', _n{i}" for i, c in enumerate(cols))
    return agg.selectExpr(f"stack({len(cols)}, {pairs}) as (column_name, failures)")


# ---------------------------------------------------------------------------
# catalogue evaluation
# ---------------------------------------------------------------------------
# Every check is a number:
#   unique / unique_combination -> values (or column tuples) seen more than once
#   not_null                    -> rows whose column is NULL
#   relationships               -> child rows whose value has no parent row
# A model's checks are one query, and its shuffle files go before the next
# model's are written: on disk is one model's share of the catalogue, not the
# whole.  Nothing is shuffled where the table is bucketed by (one of) the
# columns, and for relationships the parent by its; elsewhere values travel
# packed, counted map-side (a hot value is one row per map task).
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _value(df: DataFrame, col: str, as_text: bool = False) -> Column:
    """A column's value as it is shuffled: a whole number, or a text, packed if it is a hash key."""
    c = F.col(_q(col))
    return c if isinstance(df.schema[col].dataType, _WHOLE) and not as_text else packed_key(c.cast("string"))


def _is_text(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, T.StringType)


def _checked_rows(df: DataFrame, spec: CheckSpec) -> DataFrame:
    return df.filter(F.coalesce(F.expr(spec.where), F.lit(False))) if spec.where else df


def _n_repeated(df: DataFrame, spec: CheckSpec, dealt: str | None) -> DataFrame:
    """unique, unique_combination: values seen more than once (of combinations NULL is one, too)."""
    raw = dealt in spec.columns
    if spec.test == "unique":
        df = df.filter(F.col(_q(spec.columns[0])).isNotNull())
    counts = (df.groupBy(*[(F.col(_q(c)) if raw and _is_text(df, c) else _value(df, c)).alias(f"v{i}")
                           for i, c in enumerate(spec.columns)])
              .agg((F.count(F.lit(1)) > 1).alias("repeated")))
    return counts.agg(F.count_if("repeated").alias("failures"))


def _n_orphans(df: DataFrame, spec: CheckSpec, parent: DataFrame, in_place: bool) -> DataFrame:
    """relationships: rows whose value is not NULL and no parent's."""
    col, field = spec.columns[0], spec.field
    if in_place and _is_text(df, col) and _is_text(parent, field):
        child, key = F.col(_q(col)), F.col(_q(field))
    else:
        as_text = df.schema[col].dataType != parent.schema[field].dataType
        child, key = _value(df, col, as_text), _value(parent, field, as_text)
    keys = (df.filter(F.col(_q(col)).isNotNull()).groupBy(child.alias("value"))
            .agg(F.count(F.lit(1)).alias("n")))
    parents = parent.filter(F.col(_q(field)).isNotNull()).select(key.alias("value"))
    return (keys.join(parents, "value", "left_anti")
            .agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("failures")))


def _n_null(df: DataFrame, specs: Sequence[tuple[int, CheckSpec]]) -> DataFrame:
    """not_null checks of one table: one scan."""
    n = [F.col(_q(s.columns[0])).isNull()
         & (F.coalesce(F.expr(s.where), F.lit(False)) if s.where else F.lit(True)) for _, s in specs]
    pairs = ", ".join(f"{i}, _n{i}" for i, _ in specs)
    return (df.agg(*[F.count_if(c).alias(f"_n{i}") for c, (i, _) in zip(n, specs)])
            .selectExpr(f"stack({len(specs)}, {pairs}) as (check_idx, failures)"))


def model_failures(df: DataFrame, specs: Sequence[tuple[int, CheckSpec]], tables: Mapping[str, DataFrame],
                   dealt: Mapping[str, str]) -> DataFrame:
    """(check_idx, failures) of the checks of one table."""
    parts = []
    nulls = [(i, s) for i, s in specs if s.test == "not_null"]
    if nulls:
        parts.append(_n_null(df, nulls))
    for i, s in specs:
        rows = _checked_rows(df, s)
        if s.test in ("unique", "unique_combination"):
            found = _n_repeated(rows, s, dealt.get(s.model))
        elif s.test == "relationships":
            found = _n_orphans(rows, s, tables[s.to], in_place=(
                dealt.get(s.model) == s.columns[0] and dealt.get(s.to) == s.field))
        elif s.test == "not_null":
            continue
        else:
            raise ValueError(f"unknown test {s.test!r}")
        parts.append(found.select(F.lit(i).alias("check_idx"), "failures"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def count_failures(tables: Mapping[str, DataFrame], specs: Sequence[CheckSpec],
                   dealt: Mapping[str, str] | None = None, threads: int = 1) -> list[int]:
    """Failures of each of ``specs``, evaluated now, ``threads`` models at a time.  ``dealt``: the column
    that a stored table is bucketed by, for tables of one number of buckets."""
    if not specs:
        return []
    by_model: dict[str, list[tuple[int, CheckSpec]]] = defaultdict(list)
    for i, s in enumerate(specs):
        by_model[s.model].append((i, s))

    def count(model: str) -> list[tuple[int, int]]:
        failures = model_failures(tables[model], by_model[model], tables, dealt or {})
        return [(r.check_idx, r.failures) for r in failures.collect()]  # a row a check

    with dropping_shuffles(tables[specs[0].model].sparkSession), ThreadPoolExecutor(threads) as pool:
        found = dict(pair for pairs in pool.map(count, by_model) for pair in pairs)
    return [found[i] for i in range(len(specs))]


def summarise(spark: SparkSession, specs: Sequence[CheckSpec], failures: Sequence[int]) -> DataFrame:
    """One row per check."""
    return spark.createDataFrame(
        [(s.check_id, s.model, s.test, s.column_name, n) for s, n in zip(specs, failures, strict=True)],
        "check_id string, model string, test string, column_name string, failures bigint")


def run_checks(tables: Mapping[str, DataFrame], specs: Sequence[CheckSpec],
               dealt: Mapping[str, str] | None = None, threads: int = 1) -> DataFrame:
    """Evaluate ``specs`` against ``tables`` (model name -> DataFrame) into one
    summary row per check (see `count_failures`)."""
    spark = next(iter(tables.values())).sparkSession
    return summarise(spark, specs, count_failures(tables, specs, dealt, threads))


def enforce(summary: DataFrame) -> None:
    """Gate: raise if any check failed.  Collects only the failing summary
    rows (at most one per check)."""
    failed = summary.filter(F.col("failures") > 0).collect()
    if failed:
        lines = ", ".join(f"{r.check_id}={r.failures}" for r in failed)
        raise DataQualityError(f"{len(failed)} data checks failed: {lines}")
