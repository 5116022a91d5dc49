"""Consumer side of the star: fact ⋈ SCD2 dimension joins and the documented
reporting queries.

Join rules: a fact carries durable hub keys, a dimension has one row per
version, so every fact→dimension join must pick one version — the current
one (``is_current``) or the one valid at the event time (half-open
``[effective_start_date, effective_end_date)``).  Joining on the hub key alone
fans out.

Broadcasts: none is forced.  Spark's threshold and AQE switch a join to
broadcast from the *measured* size of the finished shuffle stage and otherwise
keep a sort-merge join with skew splitting.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.keys import packed_key, unpacked_key
from tessera.operators.scd2 import current_only
from tessera.schemas import CALENDAR_END, CALENDAR_START


def join_current(fact: DataFrame, dim: DataFrame, key: str,
                 dim_cols: Sequence[str], how: str = "inner",
                 prefix: str = "") -> DataFrame:
    """Current-state join: equi on the hub key, current version only."""
    d = current_only(dim).select(key, *[F.col(c).alias(prefix + c) for c in dim_cols])
    return fact.join(d, on=key, how=how)


def _bucket(c, unit: str, bounds: tuple[str, str]):
    """Time bucket of ``c``; what lies outside ``bounds`` counts to the first or last bucket."""
    if unit not in ("year", "month"):
        raise ValueError(f"unknown bucket {unit!r}")
    lo, hi = (F.lit(b).cast("timestamp_ntz") for b in bounds)
    c = F.greatest(F.least(c, hi), lo)
    return F.year(c) if unit == "year" else F.year(c) * 12 + F.month(c) - 1


def join_as_of(fact: DataFrame, dim: DataFrame, key: str, event_col: str,
               dim_cols: Sequence[str], how: str = "inner", prefix: str = "",
               bucket: str | None = None,
               bounds: tuple[str, str] = (CALENDAR_START, CALENDAR_END)) -> DataFrame:
    """Point-in-time join: the version whose ``[start, end)`` holds the event.

    Planned as an equi-join on the hub key with the interval as a residual
    condition (hash/sort-merge join, never a nested loop).  Events before the
    first load of their key match nothing.

    With few versions per key (one per load) the residual check is cheap.
    For dimensions with long histories, ``bucket="year"`` or ``"month"``
    makes the equi-join key (hub key, time bucket): each version is repeated
    once per bucket it overlaps in which its key has events, so an event is
    only compared with the versions of its own bucket.  The copies come out of
    a join with the events' distinct keys and buckets, whose size Spark
    measures, not out of an array: an exploded one counts as small as the
    dimension and would be broadcast.  Buckets are clipped to ``bounds``;
    versions and events outside share the first or last bucket, so the rows
    are the same with any bounds."""
    d = dim.select(F.col(key).alias("_pit_key"),
                   F.col("effective_start_date").alias("_pit_start"),
                   F.col("effective_end_date").alias("_pit_end"),
                   *[F.col(c).alias(prefix + c) for c in dim_cols])
    if bucket is None:
        f, same_bucket = fact, F.lit(True)
    else:
        first, last = (_bucket(F.col(c), bucket, bounds) for c in ("_pit_start", "_pit_end"))
        f = fact.withColumn("_pit_fb", _bucket(F.col(event_col), bucket, bounds))
        slices = f.select(F.col(key).alias("_pit_slice"), F.col("_pit_fb").alias("_pit_b")).distinct()
        d = (d.withColumns({"_pit_first": first, "_pit_last": last})
             .join(slices, (F.col("_pit_key") == F.col("_pit_slice"))
                   & F.col("_pit_b").between(F.col("_pit_first"), F.col("_pit_last")))
             .drop("_pit_slice", "_pit_first", "_pit_last"))
        same_bucket = f["_pit_fb"] == d["_pit_b"]
    cond = ((f[key] == d["_pit_key"]) & same_bucket
            & (f[event_col] >= d["_pit_start"]) & (f[event_col] < d["_pit_end"]))
    return (f.join(d, cond, how)
            .drop("_pit_key", "_pit_start", "_pit_end", "_pit_b", "_pit_fb"))


def merge_as_of(fact: DataFrame, dim: DataFrame, key: str, event_col: str,
                dim_cols: Sequence[str], how: str = "inner", prefix: str = "",
                bucket: str = "month",
                bounds: tuple[str, str] = (CALENDAR_START, CALENDAR_END)) -> DataFrame:
    """``join_as_of`` as a merge: events and versions in one order of time, each event taking the last
    version before it, so that no event is compared with a version.

    Both sides are dealt by (key, time slice), so that a key with a third of the events spreads over
    its slices.  A slice that has events starts with the version carried into it, found among the
    versions of the key and a row for each such slice; slices are clipped to ``bounds``, which limits
    their number a key.

    The versions of a key must not overlap (``scd2_intervals`` makes such; gaps and zero-length
    intervals may occur).  Null keys and null times match nothing: ``inner`` drops these events, as
    it does those before the first version or in a gap, ``left`` keeps them with nulls."""
    if how not in ("inner", "left"):
        raise ValueError(f"unknown join {how!r}")
    moment = dim.schema["effective_start_date"].dataType
    versions = dim.filter(F.col(key).isNotNull() & (F.col("effective_start_date") < F.col("effective_end_date"))).select(
        F.col(key).alias("_key"), _bucket(F.col("effective_start_date"), bucket, bounds).alias("_slice"),
        F.col("effective_start_date").alias("_at"),
        F.struct(F.col("effective_start_date").alias("_start"), F.col("effective_end_date").alias("_end"),
                 *[F.col(c).alias(prefix + c) for c in dim_cols]).alias("_version"))
    dated = F.col(key).isNotNull() & F.col(event_col).isNotNull()
    events = fact.filter(dated).select(
        F.col(key).alias("_key"), _bucket(F.col(event_col), bucket, bounds).alias("_slice"),
        F.col(event_col).cast(moment).alias("_at"),
        F.struct(*[F.col(f"`{c}`") for c in fact.columns]).alias("_event"))

    # a slice's own row has no time, so that it comes before the versions that start in the slice
    up_to = (Window.partitionBy("_key").orderBy("_slice", F.col("_at").asc_nulls_first())
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    carried = (events.select("_key", "_slice").distinct()
               .unionByName(versions, allowMissingColumns=True)
               .withColumn("_version", F.last("_version", ignorenulls=True).over(up_to))
               .filter(F.col("_at").isNull() & F.col("_version").isNotNull())
               .withColumn("_at", F.col("_version._start")))

    # of equal times the version comes first: its interval holds its start
    so_far = (Window.partitionBy("_key", "_slice").orderBy("_at", F.col("_event").isNotNull())
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    merged = (events.unionByName(versions.unionByName(carried), allowMissingColumns=True)
              .withColumn("_version", F.last("_version", ignorenulls=True).over(so_far))
              .filter(F.col("_event").isNotNull()))
    holds = F.coalesce(F.col("_at") < F.col("_version._end"), F.lit(False))
    names = [prefix + c for c in dim_cols]
    if how == "inner":
        return merged.filter(holds).select("_event.*", *[F.col("_version")[c].alias(c) for c in names])
    found = merged.select("_event.*", *[F.when(holds, F.col("_version")[c]).alias(c) for c in names])
    rest = fact.filter(~dated).select(
        "*", *[F.lit(None).cast(dim.schema[c].dataType).alias(prefix + c) for c in dim_cols])
    return found.union(rest)


def join_calendar(fact: DataFrame, dim_date: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Join on the integer ``date_key``.  Spark's own size threshold decides
    whether the calendar is broadcast."""
    return fact.join(dim_date.select("date_key", *cols), on="date_key", how="inner")


# ---------------------------------------------------------------------------
# documented reporting queries
# ---------------------------------------------------------------------------
def spend_by_city_quarter(fact_transactions: DataFrame, dim_customer: DataFrame,
                          dim_date: DataFrame) -> DataFrame:
    """Transaction spend by current customer city, year and quarter.

    Same result as joining every transaction to its customer and summing,
    but the fact is first summed per (customer, year, quarter) — after the
    map-side calendar lookup — so the customer join sees one row per customer
    and quarter, and a customer with a third of all transactions is
    collapsed by partial aggregation before any shuffle."""
    f = fact_transactions.select("customer_hub_key", "date_key", "amount_usd")
    per_customer = (join_calendar(f, dim_date, ["year", "quarter"])
                    .groupBy("customer_hub_key", "year", "quarter")
                    .agg(F.sum("amount_usd").alias("spend")))
    joined = join_current(per_customer, dim_customer, "customer_hub_key", ["city"])
    return (joined.groupBy("city", "year", "quarter")
            .agg(F.sum("spend").cast("decimal(25,2)").alias("total_spend"))
            .orderBy("year", "quarter", "city"))


def transactions_current(fact_transactions: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Each transaction with the customer's current attributes."""
    f = fact_transactions.select("transaction_hub_key", "customer_hub_key", "amount_usd")
    return join_current(f, dim_customer, "customer_hub_key", ["city", "credit_tier"])


def transactions_point_in_time(fact_transactions: DataFrame, dim_customer: DataFrame,
                               bucket: str | None = None, merge: bool = False) -> DataFrame:
    """Each transaction with the customer version valid at transaction time; ``merge``: by
    ``merge_as_of``."""
    f = fact_transactions.select("transaction_hub_key", "customer_hub_key",
                                 "transaction_date", "amount_usd")
    cols = ["customer_key", "city", "credit_tier", "effective_start_date"]
    if merge:
        return merge_as_of(f, dim_customer, "customer_hub_key", "transaction_date", cols,
                           bucket=bucket or "month")
    return join_as_of(f, dim_customer, "customer_hub_key", "transaction_date", cols, bucket=bucket)


def activity_by_day(fact_transactions: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Transactions and spend per calendar day, with every attribute of the day.  The fact is
    summed per day first, so the calendar join sees one row a day."""
    per_day = (fact_transactions.groupBy("date_key")
               .agg(F.count(F.lit(1)).alias("transactions"),
                    F.sum("amount_usd").cast("decimal(25,2)").alias("spend")))
    return join_calendar(per_day, dim_date, [c for c in dim_date.columns if c != "date_key"])


def transactions_star(fact_transactions: DataFrame, dim_customer: DataFrame,
                      dim_account: DataFrame, dim_merchant: DataFrame,
                      dim_date: DataFrame) -> DataFrame:
    """Each transaction with what is current of its customer, account and merchant, and its day.
    Keys are joined packed, so that they travel as 16 bytes.  The merchants, which are few, come
    first: what a larger dimension shuffles is then free of their keys; the calendar, whose size is
    fixed, comes last."""
    def packed(df: DataFrame, *keys: str) -> DataFrame:
        return df.withColumns({k: packed_key(k) for k in keys})

    keys = ("transaction_hub_key", "customer_hub_key", "account_hub_key", "merchant_hub_key")
    f = packed(fact_transactions.select(*keys, "date_key", "amount_usd"), *keys)
    f = join_current(f, packed(dim_merchant, "merchant_hub_key"), "merchant_hub_key",
                     ["merchant_name", "city"], prefix="m_").drop("merchant_hub_key")
    f = join_current(f, packed(dim_customer, "customer_hub_key"), "customer_hub_key",
                     ["city", "credit_tier"], prefix="customer_").drop("customer_hub_key")
    f = join_current(f, packed(dim_account, "account_hub_key"), "account_hub_key", ["account_type"])
    f = join_calendar(f, dim_date, ["year", "quarter", "month"])
    return f.select(unpacked_key("transaction_hub_key").alias("transaction_hub_key"), "date_key", "year", "quarter", "month",
                    "customer_city", "customer_credit_tier", "account_type",
                    "m_merchant_name", "m_city", "amount_usd") \
            .withColumnRenamed("m_merchant_name", "merchant_name") \
            .withColumnRenamed("m_city", "merchant_city")


def loans_star(fact_loans: DataFrame, dim_customer: DataFrame, dim_date: DataFrame) -> DataFrame:
    f = fact_loans.select("loan_hub_key", "customer_hub_key", "date_key",
                          "loan_amount", "interest_rate")
    f = join_current(f, dim_customer, "customer_hub_key", ["city", "credit_tier"])
    f = join_calendar(f, dim_date, ["year", "quarter"])
    return f.select("loan_hub_key", "customer_hub_key", "date_key", "year", "quarter",
                    "city", "credit_tier", "loan_amount", "interest_rate")


def balances_star(fact_account_balance: DataFrame, dim_customer: DataFrame,
                  dim_account: DataFrame, dim_date: DataFrame) -> DataFrame:
    f = fact_account_balance.select("account_hub_key", "customer_hub_key", "date_key",
                                    "balance_usd")
    f = join_current(f, dim_customer, "customer_hub_key", ["city"])
    f = join_current(f, dim_account, "account_hub_key", ["account_type", "open_date"])
    f = join_calendar(f, dim_date, ["year", "quarter"])
    return f.select("account_hub_key", "customer_hub_key", "date_key", "year", "quarter",
                    "city", "account_type", "open_date", "balance_usd")


def cards_with_accounts(dim_card: DataFrame, dim_account: DataFrame) -> DataFrame:
    """Cards reach facts and customers only through their account
    (attribute-level relationship): current card ⋈ current account."""
    c = current_only(dim_card).select("card_hub_key", "card_id", "card_type", "account_hub_key")
    return join_current(c, dim_account, "account_hub_key",
                        ["account_id", "account_type", "customer_hub_key"])


def card_account_rollup(dim_card: DataFrame, dim_account: DataFrame) -> DataFrame:
    return (cards_with_accounts(dim_card, dim_account)
            .groupBy("account_type", "card_type")
            .agg(F.count(F.lit(1)).alias("card_count")))
