"""End-to-end properties of the warehouse built from the sf0.001 tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window

from tessera.operators import star
from tessera.plans.pipeline import run_batch, run_data_checks, source_tables
from tessera.sources.driver_tables import DriverTables
from tessera.sources.store import Warehouse

SF = "/root/testdata/sf0.001"

# expected sizes at sf0.001
EXPECTED = {
    ("silver", "hub_customer"): 150, ("silver", "hub_account"): 1500,
    ("silver", "hub_card"): 493, ("silver", "hub_branch"): 25, ("silver", "hub_merchant"): 10,
    ("silver", "hub_loan"): 202, ("silver", "hub_transaction"): 4599,
    ("silver", "link_customer_account"): 1500, ("silver", "link_account_card"): 493,
    ("silver", "link_customer_loan"): 202, ("silver", "link_account_merchant"): 4599,
    ("gold", "dim_customer"): 207, ("gold", "dim_account"): 1877, ("gold", "dim_card"): 493,
    ("gold", "dim_branch"): 25, ("gold", "dim_merchant"): 10, ("gold", "dim_date"): 5479,
    ("gold", "fact_transactions"): 4599, ("gold", "fact_loans"): 202,
    ("gold", "fact_account_balance"): 1500,
}


def test_model_sizes(warehouse_sf0001):
    for (layer, name), n in EXPECTED.items():
        assert warehouse_sf0001.read(layer, name).count() == n, name


def test_satellite_loads_per_batch(warehouse_sf0001):
    wh = warehouse_sf0001
    cust = {r["_batch"]: r.rows_added for r in wh.batches("silver", "sat_customer_details").collect()}
    acct = {r["_batch"]: r.rows_added for r in wh.batches("silver", "sat_account_details").collect()}
    assert cust == {1: 113, 2: 60, 3: 34}
    assert acct.get(1) == 1118 and acct.get(2) == 759 and acct.get(3, 0) == 0


def test_intervals_contiguous_one_current(warehouse_sf0001):
    dim = warehouse_sf0001.read("gold", "dim_customer")
    w = Window.partitionBy("customer_hub_key").orderBy("effective_start_date")
    gaps = dim.withColumn("nxt", F.lead("effective_start_date").over(w)).filter(
        F.col("nxt").isNotNull() & (F.col("nxt") != F.col("effective_end_date")))
    assert gaps.count() == 0
    cur = dim.groupBy("customer_hub_key").agg(F.count_if("is_current").alias("c"))
    assert cur.filter("c != 1").count() == 0


def test_flagship_and_point_in_time_figures(warehouse_sf0001):
    g = {n: warehouse_sf0001.read("gold", n)
         for n in ["fact_transactions", "dim_customer", "dim_date"]}
    flag = star.spend_by_city_quarter(g["fact_transactions"], g["dim_customer"], g["dim_date"])
    r = flag.agg(F.count(F.lit(1)).alias("n"), F.sum("total_spend").alias("s")).first()
    assert r.n == 907 and str(r.s) == "317364757.31"
    pit = star.transactions_point_in_time(g["fact_transactions"], g["dim_customer"])
    r = pit.agg(F.count(F.lit(1)).alias("n"), F.sum("amount_usd").alias("s")).first()
    assert r.n == 3402 and str(r.s) == "220536686.08"
    fan = g["fact_transactions"].join(g["dim_customer"], "customer_hub_key")
    assert fan.count() == 6488


def test_measures_reconcile_silver_to_gold(warehouse_sf0001):
    wh = warehouse_sf0001
    silver = wh.read("silver", "sat_transaction_details").agg(F.sum("amount_usd")).first()[0]
    fact = wh.read("gold", "fact_transactions").agg(F.sum("amount_usd")).first()[0]
    assert silver == fact


def test_all_checks_pass(spark, warehouse_sf0001):
    summary = run_data_checks(warehouse_sf0001, source_tables(DriverTables(spark, SF)))
    rows = summary.collect()
    assert len(rows) == 209
    assert [r.check_id for r in rows if r.failures] == []


def test_no_change_reload_appends_nothing(spark, scratch):
    wh = Warehouse(spark, scratch)
    t = DriverTables(spark, SF)
    src = t.batch(3)
    run_batch(wh, src, "2020-01-01 00:00:00", 1)
    before = {n: wh.read("silver", n).count() for n in ["hub_customer", "sat_customer_details",
                                                       "link_account_merchant"]}
    run_batch(wh, src, "2021-01-01 00:00:00", 2)
    after = {n: wh.read("silver", n).count() for n in before}
    assert before == after


def test_set_based_history_equals_incremental_loads(spark, warehouse_sf0001):
    from tessera.operators.bronze import extract_bronze
    from tessera.operators.vault import load_satellite_history
    from tessera.plans.models import BRONZE_COLUMNS, SAT
    from tessera.sources.driver_tables import stamp
    t = DriverTables(spark, SF)
    for sat, src in [("sat_customer_details", "customers"), ("sat_account_details", "accounts")]:
        stacked = None
        for b in (1, 2, 3):
            e = extract_bronze(t.source(src, b), BRONZE_COLUMNS[src], stamp(b))
            stacked = e if stacked is None else stacked.unionByName(e)
        history = load_satellite_history(stacked, SAT[sat])
        stored = warehouse_sf0001.read("silver", sat)
        assert history.exceptAll(stored).count() == 0
        assert stored.exceptAll(history).count() == 0


def test_flagship_total_reconciles_with_facts(warehouse_sf0001):
    g = {n: warehouse_sf0001.read("gold", n)
         for n in ["fact_transactions", "dim_customer", "dim_date"]}
    flag = star.spend_by_city_quarter(g["fact_transactions"], g["dim_customer"], g["dim_date"])
    total = flag.agg(F.sum("total_spend")).first()[0]
    cur = g["dim_customer"].filter("is_current").select("customer_hub_key")
    covered = (g["fact_transactions"].join(cur, "customer_hub_key")
               .join(g["dim_date"].select("date_key"), "date_key")
               .agg(F.sum("amount_usd")).first()[0])
    assert total == covered
    assert g["fact_transactions"].agg(F.sum("amount_usd")).first()[0] >= total


def _latest3(df, key):
    from tessera.operators.vault import latest_version
    return latest_version(df.select(key, "load_date", "hashdiff"), key)


def test_current_state_matches_history(warehouse_sf0001):
    from tessera.plans.models import SAT
    from tessera.plans.pipeline import current_state
    wh = warehouse_sf0001
    for name, key in [("sat_customer_details", "customer_hub_key"),
                      ("sat_account_details", "account_hub_key")]:
        snap = current_state(wh, SAT[name], 4)
        hist = _latest3(wh.read("silver", name), key)
        assert snap.exceptAll(hist).count() == 0 and hist.exceptAll(snap).count() == 0


def test_stale_snapshot_falls_back_to_history(spark, scratch):
    from tessera.operators.bronze import extract_bronze
    from tessera.operators.vault import load_satellite
    from tessera.plans.models import BRONZE_COLUMNS, SAT
    from tessera.plans.pipeline import current_state
    from tessera.sources.driver_tables import stamp
    wh = Warehouse(spark, scratch)
    t = DriverTables(spark, SF)
    spec = SAT["sat_customer_details"]
    run_batch(wh, {"customers": t.customers(1)}, stamp(1), 1)
    # load 2 written without its snapshot: snapshot 1 is now stale
    b2 = extract_bronze(t.customers(2), BRONZE_COLUMNS["customers"], stamp(2))
    wh.write_batch(load_satellite(b2, spec, wh.read_before("silver", spec.name, 2)),
                   "silver", spec.name, 2)
    state = current_state(wh, spec, 3)
    hist = _latest3(wh.read("silver", spec.name), spec.key_col)
    assert state.exceptAll(hist).count() == 0 and hist.exceptAll(state).count() == 0
    run_batch(wh, {"customers": t.customers(3)}, stamp(3), 3)
    assert wh.read("silver", spec.name).count() == 113 + 60 + 34


def test_gated_build_passes_and_split_catalogue_is_complete(spark, scratch,
                                                            warehouse_sf0001):
    from tessera.plans.pipeline import build_warehouse
    wh = build_warehouse(spark, SF, scratch, gate=True)
    assert wh.read("gold", "dim_customer").count() == 207
    t = source_tables(DriverTables(spark, SF))
    upstream = run_data_checks(warehouse_sf0001, t, layers=("source", "bronze", "silver"))
    downstream = run_data_checks(warehouse_sf0001, layers=("gold",))
    assert upstream.count() + downstream.count() == 209


def test_a_model_is_built_with_its_upstream_alone(spark, scratch):
    from tessera.plans.pipeline import build_models, with_upstream
    from tessera.sources.driver_tables import DriverTables
    assert with_upstream(["hub_account"]) == ["bronze_accounts", "hub_account"]
    wh, built = Warehouse(spark, scratch), set()
    tables = DriverTables(spark, SF)
    build_models(wh, tables, ["hub_account"], built)
    assert built == {"bronze_accounts", "hub_account"}
    assert wh.batch_ids("silver", "hub_account") == [1, 2, 3]
    assert not wh.exists("bronze", "bronze_transactions") and not wh.exists("silver", "sat_account_details")
    before = wh.read("bronze", "bronze_accounts")
    build_models(wh, tables, ["dim_account"], built)      # later: what is there stays
    assert {"dim_account", "sat_account_details", "link_customer_account"} <= built and before.count() == 1500
    wh.drop()


def test_models_built_one_by_one_equal_the_whole_build(spark, scratch, warehouse_sf0001):
    from tessera.plans.pipeline import build_warehouse
    wh = build_warehouse(spark, SF, scratch)
    for layer, name in [("bronze", "bronze_accounts"), ("silver", "hub_account"),
                        ("silver", "link_customer_account"), ("silver", "sat_account_details"),
                        ("gold", "dim_account"), ("gold", "dim_customer"), ("gold", "fact_transactions")]:
        a, b = (sorted(map(str, w.read(layer, name).collect())) for w in (wh, warehouse_sf0001))
        assert a == b, name
    wh.drop()


def test_stored_tables_are_coded(spark, scratch):
    import glob
    wh = Warehouse(spark, scratch)
    df = spark.range(100).selectExpr("md5(string(id)) k", "id")
    wh.write_full(df, "gold", "t")
    wh.write_batch(df, "silver", "t", 1, key="k")
    for layer in ("gold", "silver"):
        files = glob.glob(f"{scratch}/{layer}/t/**/*.parquet", recursive=True)
        assert files and all(f.endswith(".zstd.parquet") for f in files)
    wh.drop()


def test_models_drop_what_they_shuffled(spark, scratch):
    """A model's shuffle files go once it is written, and the session is left as it was."""
    import time

    from tessera.plans.pipeline import build_models
    from tessera.session import DROP_SHUFFLES
    before = spark.conf.get(DROP_SHUFFLES, None)
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled() -> int:
        names = disk.getAllBlocks().mkString(" ").split()
        return sum(n.startswith("shuffle_") for n in names)

    wh, held = Warehouse(spark, scratch), shuffled()
    build_models(wh, DriverTables(spark, SF), ["hub_account"], set())
    for _ in range(50):  # files are removed beside the driver's work
        if shuffled() <= held:
            break
        time.sleep(0.2)
    assert shuffled() <= held
    assert spark.conf.get(DROP_SHUFFLES, None) == before
    wh.drop()


def test_models_leave_no_snapshot_behind(spark, scratch):
    """Snapshots are for loads to come; the loads of these models are all written."""
    from tessera.plans.models import SAT
    from tessera.plans.pipeline import STATE, build_models, current_state
    wh = Warehouse(spark, scratch)
    build_models(wh, DriverTables(spark, SF), ["sat_account_details"], set())
    assert wh.batch_ids(STATE, "sat_account_details") == []
    assert current_state(wh, SAT["sat_account_details"], 4).count() == 1500
    wh.drop()


def test_large_tables_go_when_nothing_reads_them(spark, scratch, warehouse_sf0001, monkeypatch):
    """With every table large: what no query named goes, in steps, and comes again with the same rows."""
    from tessera.plans import pipeline
    monkeypatch.setattr(pipeline, "LARGE", 0)
    wh, built, tables = Warehouse(spark, scratch), set(), DriverTables(spark, SF)
    keep = {"fact_transactions"}
    pipeline.build_models(wh, tables, ["fact_transactions"], built, keep=keep)
    assert built == keep
    assert not wh.exists("silver", "sat_transaction_details") and not wh.exists("bronze", "bronze_transactions")
    fact = wh.read("gold", "fact_transactions")    # built in slices
    keep.add("dim_customer")
    pipeline.build_models(wh, tables, ["dim_customer"], built, keep=keep)
    assert built == keep and not wh.exists("gold", "dim_account")
    keep.add("hub_account")
    pipeline.build_models(wh, tables, ["hub_account", "fact_transactions"], built, keep=keep)
    assert built == keep and wh.batch_ids("silver", "hub_account") == [1, 2, 3]
    for layer, name, df in [("gold", "fact_transactions", fact), ("silver", "hub_account", None), ("gold", "dim_customer", None)]:
        got = wh.read(layer, name) if df is None else df
        assert sorted(map(str, got.collect())) == sorted(map(str, warehouse_sf0001.read(layer, name).collect())), name
    wh.drop()


def test_models_are_checked_before_large_tables_go(spark, scratch, monkeypatch):
    """Every check of the catalogue has its tables, though none is left at the end."""
    from tessera.operators.checks import CheckSpec
    from tessera.plans import pipeline
    from tessera.plans.check_specs import CHECK_SPECS
    monkeypatch.setattr(pipeline, "LARGE", 0)
    seen = []
    count = pipeline.count_failures
    monkeypatch.setattr(pipeline, "count_failures", lambda tables, specs, *a: seen.extend(specs) or count(tables, specs, *a))
    failing = [CheckSpec("hub_account", "relationships", ("account_id",), to="hub_branch", field="branch_id"),
               CheckSpec("dim_account", "unique", ("account_hub_key",)),
               CheckSpec("source_accounts", "unique", ("customer_id",))]
    wh, built = Warehouse(spark, scratch), set()
    got = pipeline.check_models(wh, DriverTables(spark, SF), [*CHECK_SPECS, *failing], built, set())
    assert got[:-3] == [0] * 209 and built == set()
    t = DriverTables(spark, SF)
    accounts = t.accounts(3)
    orphans = accounts.join(t.branches(3), accounts.account_id == F.col("branch_id"), "left_anti").count()
    versions = 1877 - 1500  # second versions, of as many accounts
    assert got[-3:] == [orphans, versions, accounts.groupBy("customer_id").count().filter("count > 1").count()]
    assert sorted(map(str, seen)) == sorted(map(str, [*CHECK_SPECS, *failing]))  # each once
    wh.drop()


def test_steps_hold_each_model_once_after_what_it_reads():
    from tessera.plans.pipeline import build_steps, upstream, with_upstream
    from tessera.plans.queries import MODELS
    order = with_upstream(MODELS)
    steps = build_steps(order)
    assert sorted(m for s in steps for m in s) == sorted(order)
    done = set()
    for step in steps:
        for m in step:
            assert all(u in done or u in step for u in upstream(m)), m
        done |= set(step)
    # the largest source last: what others are built from is gone by then
    assert [m for s in steps for m in s].index("dim_customer") < [m for s in steps for m in s].index("link_account_merchant")
