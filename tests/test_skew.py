"""Hot keys of a join's right side, and the latest version as an aggregate."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tessera.operators import skew
from tessera.operators.skew import left_join_salted
from tessera.operators.vault import latest_version
from tessera.plans import gold
from tests.test_plans import plan, with_conf


def rows(df):
    return sorted(map(str, map(tuple, df.collect())))


@pytest.mark.parametrize("hot_rows", [0, 50, 10**9])
def test_equals_a_plain_left_join(spark, hot_rows):
    left = spark.range(300).select(
        F.when(F.col("id") % 11 == 0, F.lit(None)).otherwise(F.concat(F.lit("k"), F.col("id") % 40)).alias("k"), "id")
    right = spark.range(2000).select(
        F.when(F.col("id") % 13 == 0, F.lit(None)).when(F.col("id") % 3 == 0, F.lit("k1"))
        .otherwise(F.concat(F.lit("k"), F.col("id") % 37)).alias("k"), (F.col("id") % 1500).alias("parent"))
    got = left_join_salted(left, right, "k", "parent", hot_rows, salts=7, extra={"most": F.max("parent")})
    want = (left.join(right, "k", "left")
            .join(right.groupBy("k").agg(F.max("parent").alias("most")), "k", "left"))
    plain = left_join_salted(left, right, "k", "parent", hot_rows, salts=7)
    assert rows(plain.select("k", "id", "parent")) == rows(left.join(right, "k", "left").select("k", "id", "parent"))
    assert rows(got.select("k", "id", "parent", "most")) == rows(want.select("k", "id", "parent", "most"))


def test_no_links_and_no_rows(spark):
    left = spark.createDataFrame([("a", 1), (None, 2)], "k string, id int")
    none = spark.createDataFrame([], "k string, parent string")
    assert rows(left_join_salted(left, none, "k", "parent", 0)) == rows(left.withColumn("parent", F.lit(None)))
    assert left_join_salted(left.limit(0), none, "k", "parent").count() == 0


def test_a_hot_parent_is_spread_over_tasks(spark, monkeypatch):
    # one account belongs to a third of all customers
    links = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.md5(F.col("id").cast("string"))).alias("account_hub_key"),
        F.md5((F.col("id") + 9).cast("string")).alias("customer_hub_key"))
    facts = links.select("account_hub_key").distinct()
    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
             "spark.sql.shuffle.partitions": "64"}

    def largest():
        out = gold._with_customer(facts, links).withColumn("task", F.spark_partition_id())
        return max(r["count"] for r in out.groupBy("task").count().collect()), out.count()

    assert with_conf(spark, confs, largest)[0] > 3000
    monkeypatch.setattr(skew, "HOT_ROWS", 100)
    most, total = with_conf(spark, confs, largest)
    assert total == 9000 and most < 1000


def test_latest_of_equals_the_ranking(spark):
    sat = spark.createDataFrame([
        ("a", 1, None, "2020-01-01", "s", "0f"), ("a", 2, "x", "2021-01-01", "s", "1f"),
        ("a", 3, "y", "2021-01-01", "t", "0e"), ("b", None, None, "2019-01-01", None, "ff"),
        ("c", 5, "z", "2022-01-01", "s", "aa"), ("c", 6, "z", "2021-01-01", "s", "00")],
        "k string, v int, w string, d string, record_source string, hashdiff string").withColumn(
        "load_date", F.col("d").cast("timestamp_ntz"))
    cols = ["k", "v", "w", "load_date", "record_source"]
    want = latest_version(sat, "k").select(*cols)
    assert rows(gold.latest_of(sat, "k", ["v", "w"]).select(*cols)) == rows(want)


def test_facts_rank_nothing(spark, warehouse_sf0001):
    from tessera.plans.pipeline import gold_model
    for name in ("fact_transactions", "fact_loans", "fact_account_balance"):
        assert "Window" not in plan(gold_model(warehouse_sf0001, name))
    p = with_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"},
                  lambda: plan(gold_model(warehouse_sf0001, "fact_transactions")))
    join = next(line for line in p.split("\n") if "Join [transaction_hub_key" in line)
    below = p[p.index(join):].split("\n")
    depth = len(join) - len(join.lstrip(" :+-"))
    inside = [x for x in below[1:] if len(x) - len(x.lstrip(" :+-")) > depth]
    first = next((k for k, x in enumerate(below[1:]) if len(x) - len(x.lstrip(" :+-")) <= depth), len(below))
    assert not any("Exchange" in x for x in inside[:first]), p


def test_keys_of_facts_are_shuffled_packed(spark, warehouse_sf0001):
    from tessera.operators import star
    from tessera.plans.pipeline import gold_model
    p = with_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"},
                  lambda: plan(gold_model(warehouse_sf0001, "fact_transactions")))
    assert p.index("hex(transaction_hub_key") < p.index("Exchange hashpartitioning(_place") < p.index("unhex(")
    g = [warehouse_sf0001.read("gold", n) for n in
         ("fact_transactions", "dim_customer", "dim_account", "dim_merchant", "dim_date")]
    p = with_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}, lambda: plan(star.transactions_star(*g)))
    # the widest dimensions come last: their shuffles carry no merchant's key
    assert p.index("Exchange hashpartitioning(account_hub_key") < p.index("Exchange hashpartitioning(customer_hub_key")
    assert p.index("Exchange hashpartitioning(customer_hub_key") < p.index("Exchange hashpartitioning(merchant_hub_key")
    assert p.index("unhex(") > p.index("Exchange hashpartitioning(merchant_hub_key")


def test_facts_with_keys_that_are_no_md5(spark):
    facts = spark.createDataFrame([("t1", "a1"), ("t2", "a2"), ("t3", None)], "transaction_hub_key string, account_hub_key string")
    links = spark.createDataFrame([("a1", "c1"), ("a1", "c2"), (None, "c3")], "account_hub_key string, customer_hub_key string")
    got = gold._with_customer(facts, links, ("transaction_hub_key", "account_hub_key"))
    want = facts.join(links, "account_hub_key", "left")
    cols = ["transaction_hub_key", "account_hub_key", "customer_hub_key"]
    assert rows(got.select(*cols)) == rows(want.select(*cols))


@pytest.mark.parametrize("classes", [1, 3, 1 << 15])
def test_hot_keys_are_exact_whatever_shares_their_class(spark, monkeypatch, classes):
    monkeypatch.setattr(skew, "CLASSES", classes)
    right = spark.range(1000).select(F.when(F.col("id") < 400, F.lit("hot")).otherwise(
        F.concat(F.lit("k"), F.col("id") % 50)).alias("k"))
    assert rows(skew.hot_keys(right, "k", 100)) == rows(spark.sql("select 'hot' k, true"))
    # no key is hot, the class of all keys is
    assert skew.hot_keys(right.filter("k != 'hot'"), "k", 100).count() == 0


def test_hot_keys_are_counted_in_full_classes_alone(spark, warehouse_sf0001):
    links = warehouse_sf0001.read("silver", "link_customer_account")
    p = plan(skew.hot_keys(links, "account_hub_key", 100))
    # what the keys are counted of has passed the classes
    assert p.index("Exchange hashpartitioning(account_hub_key") < p.index("LeftSemi"), p
    assert "Exchange hashpartitioning(_class" in p, p


def test_parents_and_counts_are_shuffled_packed(spark, warehouse_sf0001):
    from tessera.plans.pipeline import gold_model
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1"}
    p = with_conf(spark, off, lambda: plan(gold_model(warehouse_sf0001, "dim_account")))
    dealt = [line for line in p.split("\n") if "REPARTITION_BY_COL" in line]
    assert dealt and all("hex(account_hub_key" in line for line in dealt), p
    assert p.index(dealt[0]) < p.index("unhex(account_hub_key") and "unhex(customer_hub_key" in p, p
    p = plan(gold.account_counts(warehouse_sf0001.read("gold", "dim_account")))
    assert p.index("Exchange hashpartitioning(_groupingexpression") < p.index("unhex("), p


def test_counts_by_keys_that_are_no_md5(spark):
    dim = spark.createDataFrame([("c1", "Checking", True), ("c1", "Savings", True), ("c1", "Savings", False),
                                 (None, "Credit", True), ("A" * 32, "Savings", True), ("", "checking", True)],
                                "customer_hub_key string, account_type string, is_current boolean")
    got = gold.account_counts(dim)
    assert got.schema["customer_hub_key"].dataType.simpleString() == "string"
    assert rows(got) == sorted(map(str, [("c1", 2, 1, 1), (None, 1, 0, 0), ("A" * 32, 1, 0, 1), ("", 1, 0, 0)]))


@pytest.mark.parametrize("slices", [1, 2, 4, 7])
def test_slices_hold_each_row_once(spark, slices):
    keys = spark.range(500).selectExpr("md5(string(id)) k").union(
        spark.createDataFrame([(None,), ("",), ("zz",), ("40",), ("é",), ("F0",)], "k string"))
    conds = gold.key_slices("k", slices)
    assert len(conds) == slices
    assert rows(keys) == sorted(r for c in conds for r in rows(keys.filter(c)))


def test_the_key_travels_once(spark, warehouse_sf0001):
    """The place that a row is dealt to holds its key."""
    p = with_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}, lambda: plan(left_join_salted(
        warehouse_sf0001.read("gold", "fact_transactions").select("account_hub_key", "amount_usd"),
        warehouse_sf0001.read("silver", "link_customer_account").select("account_hub_key", "customer_hub_key"),
        "account_hub_key", "customer_hub_key")))
    dealt = p[p.index("Exchange hashpartitioning(_place"):].split("\n")[1]
    assert "amount_usd" in dealt and "account_hub_key#" not in dealt.split("CASE")[0], dealt


def test_star_joins_packed_keys(spark, warehouse_sf0001):
    from tessera.operators import star
    g = [warehouse_sf0001.read("gold", n) for n in
         ("fact_transactions", "dim_customer", "dim_account", "dim_merchant", "dim_date")]
    p = with_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}, lambda: plan(star.transactions_star(*g)))
    for key in ("customer_hub_key", "account_hub_key", "merchant_hub_key", "transaction_hub_key"):
        assert f"unhex({key}" in p, key
    # the calendar comes last, so that its columns are in no other shuffle
    assert p.index("Exchange hashpartitioning(date_key") < p.index("Exchange hashpartitioning(account_hub_key")
