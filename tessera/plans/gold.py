"""Gold star models: SCD2 dimensions, the calendar and three facts.

Every function takes the upstream models as DataFrames and returns the model
— composition only; the pipeline decides where they are read from and
written to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.dates import date_key, month_start
from tessera.functions.keys import packed_key, unpacked_key
from tessera.functions.tiers import credit_tier
from tessera.operators.calendar import date_dimension
from tessera.operators.scd2 import build_scd2_dim, current_only
from tessera.operators.skew import left_join_salted
from tessera.schemas import CHECKING, SAVINGS


# ---------------------------------------------------------------------------
# dimensions
# ---------------------------------------------------------------------------
def dim_date(spark: SparkSession) -> DataFrame:
    return date_dimension(spark)


def dim_branch(sat: DataFrame, hub: DataFrame) -> DataFrame:
    return build_scd2_dim(sat, hub, "branch_hub_key", "branch_id",
                          ["branch_name", "city", "country", "manager_name"], "branch_key")


def dim_merchant(sat: DataFrame, hub: DataFrame) -> DataFrame:
    return build_scd2_dim(sat, hub, "merchant_hub_key", "merchant_id",
                          ["merchant_name", "city"], "merchant_key")


def dim_card(sat: DataFrame, hub: DataFrame, link_account_card: DataFrame) -> DataFrame:
    return build_scd2_dim(sat, hub, "card_hub_key", "card_id",
                          ["card_type", "expiration_date"], "card_key",
                          parent_link=link_account_card, parent_key="account_hub_key")


def dim_account(sat: DataFrame, hub: DataFrame, link_customer_account: DataFrame) -> DataFrame:
    """No balance here: the balance is a measure of fact_account_balance."""
    return build_scd2_dim(sat, hub, "account_hub_key", "account_id",
                          ["account_type", "open_date"], "account_key",
                          parent_link=link_customer_account, parent_key="customer_hub_key")


def account_counts(dim_account_df: DataFrame) -> DataFrame:
    """Current accounts per customer, total and by type (case-sensitive).  A customer's accounts lie
    far apart, so that nearly a row an account is shuffled: with the key packed."""
    t = F.col("account_type")
    counts = current_only(dim_account_df).groupBy(packed_key("customer_hub_key").alias("customer_hub_key")).agg(
        F.count(F.lit(1)).alias("total_account_count"),
        F.count_if(t == CHECKING).alias("checking_account_count"),
        F.count_if(t == SAVINGS).alias("savings_account_count"))
    return counts.withColumn("customer_hub_key", unpacked_key("customer_hub_key"))


def loan_counts(fact_loans_df: DataFrame) -> DataFrame:
    """All loans per customer (facts have no versions)."""
    return fact_loans_df.groupBy("customer_hub_key").agg(
        F.count(F.lit(1)).alias("total_loan_count"),
        F.sum("loan_amount").alias("total_loan_amount"))


DIM_CUSTOMER_COLUMNS = [
    "customer_key", "customer_hub_key", "customer_id", "first_name", "last_name", "email",
    "city", "credit_score", "credit_tier", "created_date", "acquisition_month",
    "total_account_count", "checking_account_count", "savings_account_count",
    "total_loan_count", "total_loan_amount",
    "effective_start_date", "effective_end_date", "is_current", "record_source",
]


def dim_customer(sat: DataFrame, hub: DataFrame, dim_account_df: DataFrame,
                 fact_loans_df: DataFrame) -> DataFrame:
    """Customer versions + tier + acquisition month + present-day rollups.

    The rollups describe the customer *now* and are stamped on every
    version.  Both rollups are aggregated before joining (no fan-out); the
    versions lie by the customer key, so the two left joins add no shuffle of
    them (of the account counts, which are summed by packed keys, a row a
    customer)."""
    versions = build_scd2_dim(sat, hub, "customer_hub_key", "customer_id",
                              ["first_name", "last_name", "email", "city",
                               "credit_score", "created_date"], "customer_key")
    versions = (versions.withColumn("credit_tier", credit_tier("credit_score"))
                .withColumn("acquisition_month", month_start("created_date")))
    rolled = (versions.join(account_counts(dim_account_df), "customer_hub_key", "left")
              .join(loan_counts(fact_loans_df), "customer_hub_key", "left"))
    for c in ["total_account_count", "checking_account_count", "savings_account_count",
              "total_loan_count"]:
        rolled = rolled.withColumn(c, F.coalesce(F.col(c), F.lit(0)).cast("bigint"))
    rolled = rolled.withColumn(
        "total_loan_amount",
        F.coalesce(F.col("total_loan_amount"), F.lit(0)).cast("decimal(25,2)"))
    return rolled.select(*DIM_CUSTOMER_COLUMNS)


# ---------------------------------------------------------------------------
# facts
# ---------------------------------------------------------------------------
def latest_of(sat: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """The latest version of each key, as the greatest (load_date, ...) of its rows: an aggregate
    with partial maxima, which keeps one row a key and task and ranks nothing.  Of versions with
    equal load dates (a duplicate id in one extract) the one with the least fingerprint counts."""
    # the least fingerprint among the latest rows: the maximum of the inverted digits
    inverted = F.translate("hashdiff", "0123456789abcdef", "fedcba9876543210")
    row = F.struct("load_date", inverted.alias("order"), *cols, "record_source")
    latest = sat.groupBy(key).agg(F.max(row).alias("v"))
    return latest.select(key, *[F.col(f"v.{c}").alias(c) for c in [*cols, "load_date", "record_source"]])


def _with_customer(facts: DataFrame, link_customer_account: DataFrame,
                   keys: tuple[str, ...] = ("account_hub_key",)) -> DataFrame:
    """The customer through the account (left: an unlinked account keeps the row).  ``keys``, those
    of the facts, are packed while they are shuffled."""
    links = link_customer_account.select(*[packed_key(k).alias(k)
                                           for k in ("account_hub_key", "customer_hub_key")])
    f = left_join_salted(facts.withColumns({k: packed_key(k) for k in keys}), links,
                         "account_hub_key", spread="customer_hub_key")
    return f.withColumns({k: unpacked_key(k) for k in [*keys, "customer_hub_key"]})


def key_slices(key: str, slices: int) -> list[Column]:
    """Conditions that part rows by ``key``, each row in one of them, into equal parts if it is an md5."""
    ends = [f"{256 * i // slices:02x}" for i in range(1, slices)]
    k = F.col(key)
    first = [k.isNull() | (k < ends[0])] if ends else [F.lit(True)]
    return first + [(k >= lo) & (k < hi) for lo, hi in zip(ends, ends[1:])] + [k >= hi for hi in ends[-1:]]


def fact_transactions(link_account_merchant: DataFrame, sat_transaction: DataFrame,
                      link_customer_account: DataFrame) -> DataFrame:
    """One row per transaction: latest satellite version ⋈ link, plus the
    customer through the account.  Link and satellite are bucketed by the
    transaction, so their join shuffles neither."""
    cur = latest_of(sat_transaction, "transaction_hub_key", ["amount_usd", "transaction_date"])
    link = link_account_merchant.select("transaction_hub_key", "account_hub_key",
                                        "merchant_hub_key")
    f = _with_customer(link.join(cur, "transaction_hub_key", "inner"), link_customer_account,
                       ("transaction_hub_key", "account_hub_key", "merchant_hub_key"))
    return f.select(
        "transaction_hub_key", "account_hub_key", "merchant_hub_key", "customer_hub_key",
        date_key("transaction_date").alias("date_key"),
        "transaction_date", "amount_usd", "record_source", "load_date")


def fact_loans(link_customer_loan: DataFrame, sat_loan: DataFrame) -> DataFrame:
    cur = latest_of(sat_loan, "loan_hub_key", ["loan_amount", "interest_rate", "start_date"])
    link = link_customer_loan.select("loan_hub_key", "customer_hub_key")
    f = link.join(cur, "loan_hub_key", "inner")
    return f.select(
        "loan_hub_key", "customer_hub_key", date_key("start_date").alias("date_key"),
        "start_date", "loan_amount", "interest_rate", "record_source", "load_date")


def fact_account_balance(sat_account: DataFrame, link_customer_account: DataFrame) -> DataFrame:
    """Current balance per account; its time axis is the capture (load) date,
    not the open date."""
    cur = latest_of(sat_account, "account_hub_key", ["balance_usd", "open_date"])
    f = _with_customer(cur, link_customer_account)
    return f.select(
        "account_hub_key", "customer_hub_key", date_key("load_date").alias("date_key"),
        F.col("load_date").cast("date").alias("snapshot_date"),
        "open_date", "balance_usd", "record_source", "load_date")
