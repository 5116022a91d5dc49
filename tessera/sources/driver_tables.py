"""Derive the seven raw bank tables, per load batch, from the driver's
TPC-H-style parquet tables.

Batches 1-3 are stamped 2016-01-01, 2018-01-01 and 2020-01-01.  Customers and
accounts are extracted in every batch, the other five only in batch 3.  The
derivation moves dates by +20 years into the calendar range, holds back a
quarter of the customers (and their accounts) until batch 2, changes every
fifth score in batch 2 and reverts every tenth in batch 3 (A→B→A), moves every
seventh customer in batch 3 and changes every third balance from batch 2 on.

Every extract is a narrow projection of one scan; the only joins are to
``nation``/``region`` (25 / 5 rows), which Spark broadcasts on its own size
threshold — no hint is needed or given.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


BATCH_STAMPS = {
    1: "2016-01-01 00:00:00",
    2: "2018-01-01 00:00:00",
    3: "2020-01-01 00:00:00",
}
# sources extracted in each batch
BATCH_SOURCES = {
    1: ["customers", "accounts"],
    2: ["customers", "accounts"],
    3: ["customers", "accounts", "cards", "branches", "loans", "merchants", "transactions"],
}

# types of the derived tables
FIXTURE_TYPES = {
    "customers": "customer_id bigint, first_name string, last_name string, email string, "
                 "city string, credit_score bigint, created_at date",
    "accounts": "account_id bigint, customer_id bigint, account_type string, "
                "balance_usd double, open_date date",
    "cards": "card_id string, account_id bigint, card_type string, expiration_date date",
    "branches": "branch_id int, branch_name string, city string, country string, "
                "manager_name string",
    "loans": "loan_id bigint, customer_id bigint, loan_amount double, interest_rate double, "
             "start_date date",
    "merchants": "merchant_id bigint, merchant_name string, city string",
    "transactions": "transaction_id string, account_id bigint, merchant_id bigint, "
                    "amount_usd decimal(18,2), transaction_date timestamp_ntz",
}


def _typed(df: DataFrame, name: str) -> DataFrame:
    columns = [c.split(" ", 1) for c in FIXTURE_TYPES[name].split(", ")]
    return df.select(*[F.col(c).cast(t).alias(c) for c, t in columns])


def stamp(batch: int) -> Column:
    return F.lit(BATCH_STAMPS[batch]).cast("timestamp_ntz")


def _years(c: Column, n: int) -> Column:
    return c + F.expr(f"INTERVAL {n} YEARS")


class DriverTables:
    """Lazily scanned driver tables of one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # -- the seven raw sources -------------------------------------------------
    def customers(self, b: int) -> DataFrame:
        c = self.table("customer")
        n = self.table("nation")
        key = F.col("c_custkey")
        if b == 1:
            c = c.filter(key % 4 != 3)
        bump = (key % 5 == 0) if b == 2 else (
            (key % 5 == 0) & (key % 10 != 0) if b == 3 else F.lit(False))
        city = (F.when(key % 7 == 0, F.concat(F.col("n_name"), F.lit("_MOVED")))
                .otherwise(F.col("n_name"))) if b == 3 else F.col("n_name")
        df = c.join(n, c.c_nationkey == n.n_nationkey).select(
            key.alias("customer_id"),
            F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
            F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
            F.concat(F.lit("c"), key.cast("string"), F.lit("@example.com")).alias("email"),
            city.alias("city"),
            (550 + (key * 37) % 300 + F.when(bump, 40).otherwise(0)).alias("credit_score"),
            F.date_add(F.lit("2015-01-01").cast("date"), (key % 3650).cast("int")).alias("created_at"),
        )
        return _typed(df, "customers")

    def accounts(self, b: int) -> DataFrame:
        o = self.table("orders")
        key = F.col("o_orderkey")
        if b == 1:
            o = o.filter(F.col("o_custkey") % 4 != 3)
        extra = F.when(key % 3 == 0, 100).otherwise(0) if b >= 2 else F.lit(0)
        df = o.select(
            key.alias("account_id"),
            F.col("o_custkey").alias("customer_id"),
            F.when(F.col("o_orderstatus") == "F", "Checking")
             .when(F.col("o_orderstatus") == "O", "Savings")
             .otherwise("Credit").alias("account_type"),
            (F.col("o_totalprice") + extra).alias("balance_usd"),
            _years(F.col("o_orderdate"), 20).cast("date").alias("open_date"),
        )
        return _typed(df, "accounts")

    def cards(self, b: int = 3) -> DataFrame:
        o = self.table("orders").filter(F.col("o_orderstatus") == "F")
        df = o.select(
            F.concat(F.lit("C"), F.col("o_orderkey").cast("string")).alias("card_id"),
            F.col("o_orderkey").alias("account_id"),
            F.col("o_orderpriority").alias("card_type"),
            _years(F.col("o_orderdate"), 24).cast("date").alias("expiration_date"),
        )
        return _typed(df, "cards")

    def branches(self, b: int = 3) -> DataFrame:
        n = self.table("nation")
        r = self.table("region")
        df = n.join(r, n.n_regionkey == r.r_regionkey).select(
            F.col("n_nationkey").alias("branch_id"),
            F.col("n_name").alias("branch_name"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("country"),
            F.concat(F.lit("Manager "), F.col("n_name")).alias("manager_name"),
        )
        return _typed(df, "branches")

    def loans(self, b: int = 3) -> DataFrame:
        e = self.table("events").filter(F.col("event_type") == "purchase")
        df = e.select(
            F.col("event_id").alias("loan_id"),
            F.col("user_id").alias("customer_id"),
            (F.col("value") * 100).alias("loan_amount"),
            ((F.col("event_id") % 1500).cast("double") / 100).alias("interest_rate"),
            F.col("ts").cast("date").alias("start_date"),
        )
        return _typed(df, "loans")

    def merchants(self, b: int = 3) -> DataFrame:
        s = self.table("supplier")
        n = self.table("nation")
        df = s.join(n, s.s_nationkey == n.n_nationkey).select(
            F.col("s_suppkey").alias("merchant_id"),
            F.col("s_name").alias("merchant_name"),
            F.col("n_name").alias("city"),
        )
        return _typed(df, "merchants")

    def transactions(self, b: int = 3) -> DataFrame:
        # (l_orderkey, l_linenumber) repeats in lineitem: one transaction per
        # pair; the aggregate combines map-side before the shuffle
        li = self.table("lineitem")
        df = (li.groupBy("l_orderkey", "l_linenumber")
              .agg(F.min("l_suppkey").alias("merchant_id"),
                   F.sum(F.col("l_extendedprice").cast("decimal(15,2)")).alias("amount_usd"),
                   F.min("l_shipdate").alias("first_ship"))
              .select(
                  F.concat(F.col("l_orderkey").cast("string"), F.lit("-"),
                           F.col("l_linenumber").cast("string")).alias("transaction_id"),
                  F.col("l_orderkey").alias("account_id"),
                  "merchant_id", "amount_usd",
                  _years(F.col("first_ship"), 20).alias("transaction_date")))
        return _typed(df, "transactions")

    def raw_transaction_lines(self) -> DataFrame:
        """One row per lineitem row, *not* grouped: duplicate transaction ids
        (and ids × suppliers) — the input of the dedup showcases.  The load
        stamp is the ship date, so "first seen" is meaningful per id."""
        li = self.table("lineitem")
        return li.select(
            F.concat(F.col("l_orderkey").cast("string"), F.lit("-"),
                     F.col("l_linenumber").cast("string")).alias("transaction_id"),
            F.col("l_orderkey").alias("account_id"),
            F.col("l_suppkey").alias("merchant_id"),
            (F.col("l_returnflag") == "R").alias("is_returned"),
            _years(F.col("l_shipdate"), 20).alias("_loaded_at"),
        )

    def scored_customers(self) -> DataFrame:
        """Customers with text ids that have leading zeros ('000000001') and a fractional score
        (the account balance, an exact decimal)."""
        c = self.table("customer")
        return c.select(
            F.split_part("c_name", F.lit("#"), F.lit(2)).alias("customer_id"),
            F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
            F.col("c_name").alias("last_name"), F.col("c_mktsegment").alias("email"),
            F.col("c_mktsegment").alias("city"),
            F.col("c_acctbal").cast("decimal(18,2)").alias("credit_score"),
            F.lit("2015-01-01").cast("date").alias("created_at"))

    def source(self, name: str, b: int) -> DataFrame:
        if name not in BATCH_SOURCES[b]:
            raise KeyError(f"source {name!r} is not extracted in batch {b}")
        return getattr(self, name)(b)

    def batch(self, b: int) -> dict[str, DataFrame]:
        return {name: self.source(name, b) for name in BATCH_SOURCES[b]}
