"""Physical-plan shape: no nested loops / cartesian products / null-aware
anti joins; top-1 per key uses WindowGroupLimit; pruned, pushed-down scans."""

from __future__ import annotations

import pytest

from tessera.operators import star
from tessera.operators.vault import latest_version, load_hub, load_link, load_satellite
from tessera.plans.models import HUB, LINK, SAT


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


BAD = ["BroadcastNestedLoopJoin", "CartesianProduct", "NullAwareAnti"]


def test_star_queries_have_no_nested_loops(spark, warehouse_sf0001):
    g = {n: warehouse_sf0001.read("gold", n) for n in
         ["fact_transactions", "dim_customer", "dim_date", "dim_account", "dim_merchant"]}
    for df in [star.spend_by_city_quarter(g["fact_transactions"], g["dim_customer"], g["dim_date"]),
               star.transactions_point_in_time(g["fact_transactions"], g["dim_customer"]),
               star.transactions_star(g["fact_transactions"], g["dim_customer"],
                                      g["dim_account"], g["dim_merchant"], g["dim_date"])]:
        p = plan(df)
        assert not any(b in p for b in BAD), p


def test_top1_uses_window_group_limit(spark, warehouse_sf0001):
    sat = warehouse_sf0001.read("silver", "sat_customer_details")
    p = plan(latest_version(sat.select("customer_hub_key", "load_date", "hashdiff"),
                            "customer_hub_key"))
    assert "WindowGroupLimit" in p


def test_hub_anti_join_is_not_null_aware(spark, warehouse_sf0001):
    bronze = warehouse_sf0001.read("bronze", "bronze_customers")
    hub = warehouse_sf0001.read("silver", "hub_customer")
    p = plan(load_hub(bronze, HUB["hub_customer"], existing=hub))
    assert "LeftAnti" in p and "NullAwareAnti" not in p


def test_scan_prunes_columns_and_pushes_filters(spark, warehouse_sf0001):
    dim = warehouse_sf0001.read("gold", "dim_customer")
    df = dim.filter("is_current").select("customer_hub_key", "city")
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(is_current), EqualTo(is_current,true)]" in p
    assert "ReadSchema: struct<customer_hub_key:string,city:string,is_current:boolean>" in p


def _partial_before_exchange(p: str, marker: str) -> bool:
    """``marker`` (a partial operator) appears below some Exchange."""
    lines = p.split("\n")
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            depth = len(line) - len(line.lstrip(" :+-"))
            for below in lines[i + 1:]:
                d = len(below) - len(below.lstrip(" :+-"))
                if d <= depth:
                    break
                if marker in below:
                    return True
    return False


def test_hot_keys_are_combined_before_shuffles(spark, warehouse_sf0001):
    wh = warehouse_sf0001
    g = {n: wh.read("gold", n) for n in ["fact_transactions", "dim_customer", "dim_date"]}
    flag = plan(star.spend_by_city_quarter(g["fact_transactions"], g["dim_customer"],
                                           g["dim_date"]))
    assert _partial_before_exchange(flag, "partial_sum")
    hub = plan(load_hub(wh.read("bronze", "bronze_transactions"), HUB["hub_transaction"]))
    assert "WindowGroupLimit" in hub and "Partial" in hub


def test_flagship_pre_aggregation_equals_naive_join_under_skew(spark):
    from pyspark.sql import functions as F
    from tessera.operators.calendar import date_dimension
    # one customer owns most transactions
    fact = spark.range(5000).select(
        F.when(F.col("id") % 10 < 7, F.lit("hot")).otherwise(
            (F.col("id") % 37).cast("string")).alias("customer_hub_key"),
        (20160101 + (F.col("id") % 28)).cast("int").alias("date_key"),
        (F.col("id") % 97 + F.lit(0.25)).cast("decimal(15,2)").alias("amount_usd"))
    dim = spark.range(37).select(F.col("id").cast("string").alias("customer_hub_key"),
                                 (F.col("id") % 5).cast("string").alias("city"),
                                 F.lit(True).alias("is_current")).unionByName(
        spark.range(1).select(F.lit("hot").alias("customer_hub_key"), F.lit("H").alias("city"),
                              F.lit(True).alias("is_current")))
    cal = date_dimension(spark)
    got = star.spend_by_city_quarter(fact, dim, cal).collect()
    naive = (fact.join(dim.filter("is_current"), "customer_hub_key")
             .join(cal, "date_key").groupBy("city", "year", "quarter")
             .agg(F.sum("amount_usd").alias("total_spend")).collect())
    assert sorted(map(tuple, got)) == sorted(map(tuple, naive))


def stored_scans(p: str, table: str) -> list[list[str]]:
    """For each scan of a stored table, the operators between it and the plan's top."""
    lines, out = p.split("\n"), []
    depth = lambda x: len(x) - len(x.lstrip(" :+-"))
    for i, line in enumerate(lines):
        if f".{table}[" in line:
            above, d = [], depth(line)
            for up in reversed(lines[:i]):
                if depth(up) < d and up.strip():
                    above.append(up.strip(" :+-"))
                    d = depth(up)
            out.append(above)
    return out


@pytest.mark.parametrize("rows", [50, 100_000])
def test_stored_keys_are_neither_shuffled_nor_sorted(spark, warehouse_sf0001, rows):
    from tessera.operators import vault
    from tessera.plans.models import LINK, SAT
    wh = warehouse_sf0001
    bronze = wh.read("bronze", "bronze_transactions").limit(rows)
    for spec, load in [(HUB["hub_transaction"], load_hub), (LINK["link_account_merchant"], vault.load_link),
                       (SAT["sat_transaction_details"], vault.load_satellite)]:
        key = getattr(spec, "dealt_by", None) or spec.key_col
        ids = spec.dealt_ids if hasattr(spec, "dealt_ids") else [spec.id_col]
        stored = vault.stored_of_extract(wh.read_before("silver", spec.name, 9), bronze, key, ids)
        p = plan(load(bronze, spec, stored))
        for above in stored_scans(p, spec.name):
            joins = [k for k, op in enumerate(above) if "Join" in op]
            assert "ShuffledHashJoin" in above[joins[0]] and "LeftSemi" in above[joins[0]]
            assert not any("Sort" in op and "Join" not in op for op in above[: joins[0]])
            assert not any(op.startswith("Exchange") for op in above), p
        assert stored_scans(p, spec.name)


def test_stored_joins_read_buckets_where_they_lie(spark, warehouse_sf0001):
    s = lambda n: warehouse_sf0001.read("silver", n)
    from tessera.plans import gold
    merge = {"spark.sql.autoBroadcastJoinThreshold": "-1"}
    with_conf(spark, merge, lambda: check_no_exchange(plan(gold.dim_merchant(
        s("sat_merchant_details"), s("hub_merchant"))), "sat_merchant_details", "hub_merchant"))
    with_conf(spark, merge, lambda: check_no_exchange(plan(latest_version(
        s("sat_transaction_details").select("transaction_hub_key", "load_date", "hashdiff"),
        "transaction_hub_key")), "sat_transaction_details"))


def check_no_exchange(p: str, *tables: str) -> None:
    for table in tables:
        scans = stored_scans(p, table)
        assert scans and not any(op.startswith("Exchange") for above in scans for op in above), p


def with_conf(spark, confs, work):
    old = {k: spark.conf.get(k) for k in confs}
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        return work()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_loads_of_part_of_the_stored_keys(spark, warehouse_sf0001):
    from tessera.operators import vault
    from tessera.plans.models import LINK, SAT
    wh = warehouse_sf0001
    bronze = wh.read("bronze", "bronze_transactions").limit(50)
    for spec, load in [(HUB["hub_transaction"], load_hub), (LINK["link_account_merchant"], vault.load_link),
                       (SAT["sat_transaction_details"], vault.load_satellite)]:
        key = getattr(spec, "dealt_by", None) or spec.key_col
        ids = spec.dealt_ids if hasattr(spec, "dealt_ids") else [spec.id_col]
        # half of the extract is stored
        some = wh.read("silver", spec.name).join(
            bronze.limit(25).select(vault.hub_key(*ids).alias(key)), key, "left_semi")
        want = load(bronze, spec, some)
        got = load(bronze, spec, vault.stored_of_extract(some, bronze, key, ids))
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        assert 0 < want.count() < 50


def test_merged_point_in_time_compares_no_event_with_a_version(spark, warehouse_sf0001):
    g = [warehouse_sf0001.read("gold", n) for n in ["fact_transactions", "dim_customer"]]
    p = plan(star.transactions_point_in_time(*g, merge=True))
    assert "Join" not in p and "Window" in p, p


def test_first_loads_shuffle_ids_not_hash_keys(spark, warehouse_sf0001):
    bronze = warehouse_sf0001.read("bronze", "bronze_transactions")
    for df, n in [(load_hub(bronze, HUB["hub_transaction"], buckets=8), 2),
                  (load_link(bronze, LINK["link_account_merchant"], buckets=8), 2),
                  (load_satellite(bronze, SAT["sat_transaction_details"], buckets=8), 1)]:
        p = df._jdf.queryExecution().optimizedPlan().toString()
        dealt = p.index("RepartitionByExpression")
        below = p[dealt:].split("\n", 1)[1]
        assert "md5" in p[:dealt] and "md5" not in below and plan(df).count("Exchange hash") == n


def test_bucketed_point_in_time_explodes_no_version(spark, warehouse_sf0001):
    from tessera.operators.star import transactions_point_in_time
    wh = warehouse_sf0001
    p = plan(transactions_point_in_time(wh.read("gold", "fact_transactions"), wh.read("gold", "dim_customer"),
                                        bucket="month"))
    assert "Generate" not in p and "NestedLoop" not in p


def test_dim_versions_are_not_shuffled_for_their_parents(spark, warehouse_sf0001):
    from tessera.plans.pipeline import gold_model
    p = with_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"},
                  lambda: plan(gold_model(warehouse_sf0001, "dim_account")))
    # versions of keys that are not hot meet their links where they lie
    branches = p.split("Union")[1].split("\n   :- ")[-1].split("\n   +- ")
    assert "account_hub_key" in branches[0] and "_place" not in branches[0]
    assert "_place" in branches[1]


def test_keys_of_an_extract_are_dealt_as_ids(spark, warehouse_sf0001):
    from pyspark.sql import functions as F

    from tessera.operators import vault
    wh = warehouse_sf0001
    bronze = wh.read("bronze", "bronze_accounts")
    bronze = bronze.unionByName(bronze).unionByName(bronze.limit(1).withColumn("account_id", F.lit(None).cast("long")))
    for name, key, ids in [("hub_account", "account_hub_key", ["account_id"]),
                           ("link_customer_account", "customer_account_link_key", ["customer_id", "account_id"])]:
        stored = wh.read("silver", name)
        got = vault.stored_of_extract(stored, bronze, key, ids, wh.buckets)
        p = got._jdf.queryExecution().optimizedPlan().toString()
        assert "md5" not in p[p.index("RepartitionByExpression"):].split("\n", 1)[1], p
        check_no_exchange(plan(got), name)
        want = vault.stored_of_extract(stored, bronze, key, ids)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 1500


def test_first_sightings_are_shuffled_once_for_rows_and_keys(spark, warehouse_sf0001):
    from tessera.operators import vault
    wh = warehouse_sf0001
    bronze = wh.read("bronze", "bronze_accounts")
    for spec, load, ids in [(HUB["hub_account"], load_hub, ["account_id"]),
                            (LINK["link_customer_account"], vault.load_link, ["customer_id", "account_id"])]:
        key = getattr(spec, "dealt_by", None) or spec.key_col
        stored = wh.read_before("silver", spec.name, 3)

        def new(sighted):
            return load(bronze, spec, vault.stored_of_extract(stored, bronze, key, ids, wh.buckets, sighted),
                        buckets=wh.buckets)

        got = new(True)
        assert sorted(map(str, got.collect())) == sorted(map(str, new(False).collect()))
        assert "ReusedExchange" in with_conf(spark, {"spark.sql.adaptive.enabled": "false"}, lambda: plan(new(True)))


def test_checks_shuffle_nothing_where_tables_lie_by_the_key(spark, warehouse_sf0001):
    from tessera.operators.checks import CheckSpec, model_failures
    from tessera.plans.pipeline import dealt_by
    wh = warehouse_sf0001
    t = {n: wh.read("silver", n) for n in ("hub_account", "sat_account_details", "link_customer_account")}
    t["fact_transactions"] = wh.read("gold", "fact_transactions")

    def planned(spec):
        return with_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"},
                         lambda: plan(model_failures(t[spec.model], [(0, spec)], t, dealt_by(wh))))

    key = "account_hub_key"
    for spec in [CheckSpec("hub_account", "unique", (key,)),
                 CheckSpec("sat_account_details", "relationships", (key,), to="hub_account", field=key),
                 CheckSpec("sat_account_details", "unique_combination", (key, "load_date"))]:
        assert "Exchange hashpartitioning" not in planned(spec), spec
    for spec in [CheckSpec("link_customer_account", "relationships", (key,), to="hub_account", field=key),
                 CheckSpec("fact_transactions", "unique", ("transaction_hub_key",))]:
        p = planned(spec)
        # packed and counted before
        assert p.index("Exchange hashpartitioning") < p.index("partial_count(1)") < p.index("unhex("), p


def test_checks_count_any_values(spark):
    """Keys that are md5 texts or not, numbers beside texts, nulls, scopes; dealt or not."""
    import hashlib

    from tessera.operators.checks import CheckSpec, run_checks
    md5 = hashlib.md5(b"x").hexdigest()
    t = spark.createDataFrame([(md5, 1, "1"), (md5, 2, "2"), (md5.upper(), 1, None), ("", None, "7"), (None, 7, "x"),
                               (None, None, "")], "k string, n long, s string")
    p = spark.createDataFrame([(md5, 1, "1"), (None, 2, "2")], "k string, n int, s string")
    specs = [CheckSpec("t", "unique", ("k",)), CheckSpec("t", "unique", ("n",)), CheckSpec("t", "not_null", ("k",)),
             CheckSpec("t", "relationships", ("k",), to="p", field="k"),
             CheckSpec("t", "relationships", ("n",), to="p", field="n"),
             CheckSpec("t", "relationships", ("n",), to="p", field="s"),
             CheckSpec("t", "relationships", ("s",), to="p", field="n"),
             CheckSpec("t", "unique_combination", ("k", "n")), CheckSpec("t", "unique_combination", ("k",)),
             CheckSpec("t", "not_null", ("s",), where="n = 1"), CheckSpec("t", "unique", ("k",), where="n > 1"),
             CheckSpec("t", "relationships", ("s",), to="p", field="s", where="n is null")]
    want = [1, 1, 2, 2, 1, 1, 3, 0, 2, 1, 0, 2]
    for dealt in (None, {"t": "k", "p": "k"}, {"t": "n"}):
        assert [r.failures for r in run_checks({"t": t, "p": p}, specs, dealt).collect()] == want, dealt
