"""What the catalog lists is what counts, and loads go forward."""

from __future__ import annotations

import os
import shutil

import pytest

from tessera.plans.pipeline import STATE, run_batch
from tessera.sources.driver_tables import DriverTables, stamp
from tessera.sources.store import BATCH_COL, NEXT, Warehouse

SF = "/root/testdata/sf0.001"
SAT, HUB = "sat_customer_details", "hub_customer"


def folder(wh: Warehouse, layer: str, name: str) -> str:
    return os.path.join(wh.root.removeprefix("file:"), layer, name)


def aborted(wh: Warehouse, layer: str, name: str, batch: int) -> None:
    """Leave what an interrupted write leaves: files of another load and a staging folder, in a
    partition that the catalog does not list."""
    if batch in wh.batch_ids(layer, name):
        wh.drop_batch(layer, name, batch)
    home = folder(wh, layer, name)
    others = [p for p in os.listdir(home) if p.startswith(f"{BATCH_COL}=")]
    shutil.copytree(os.path.join(home, others[0]), os.path.join(home, f"{BATCH_COL}={batch}"))
    shutil.copytree(os.path.join(home, others[0]), os.path.join(home, ".spark-staging-1", others[0]),
                    dirs_exist_ok=True)


def load(wh, tables, batch):
    run_batch(wh, {"customers": tables.customers(batch)}, stamp(batch), batch)


def history(wh):
    return sorted(map(tuple, wh.read("silver", SAT).collect()))


@pytest.fixture()
def whole(spark, scratch):
    wh, tables = Warehouse(spark, os.path.join(scratch, "whole")), DriverTables(spark, SF)
    for batch in (1, 2, 3):
        load(wh, tables, batch)
    return history(wh)


def test_interrupted_writes_leave_history_right(spark, scratch, whole):
    wh, tables = Warehouse(spark, os.path.join(scratch, "wh")), DriverTables(spark, SF)
    assert not wh.exists("silver", HUB)
    load(wh, tables, 1)
    aborted(wh, "silver", HUB, 2)
    aborted(wh, "silver", SAT, 2)
    assert wh.batch_ids("silver", HUB) == [1] and wh.read("silver", HUB).count() == 113
    load(wh, tables, 2)
    aborted(wh, STATE, SAT, 2)       # the state write of load 2 was lost
    load(wh, tables, 3)
    assert history(wh) == whole
    aborted(wh, "silver", SAT, 3)    # and load 3 is interrupted and run again
    load(wh, tables, 3)
    assert history(wh) == whole


def test_a_repeated_load_may_be_empty(spark, scratch):
    wh, df = Warehouse(spark, scratch), spark.range(9).selectExpr("id", "md5(string(id)) AS k")
    wh.write_batch(df, "silver", "t", 1, key="k")
    wh.write_batch(df, "silver", "t", 2, key="k")
    wh.write_batch(df.limit(0), "silver", "t", 2, key="k")
    assert wh.batch_ids("silver", "t") == [1, 2] and wh.read("silver", "t").count() == 9
    assert wh.read_batch("silver", "t", 2).count() == 0


def test_older_load_is_refused(spark, scratch):
    wh, tables = Warehouse(spark, os.path.join(scratch, "wh")), DriverTables(spark, SF)
    load(wh, tables, 2)
    with pytest.raises(ValueError, match="older"):
        load(wh, tables, 1)
    assert wh.batch_ids("silver", HUB) == [2]


def test_a_failed_refresh_leaves_the_previous_table(spark, scratch):
    wh = Warehouse(spark, scratch)
    wh.write_full(spark.range(3), "gold", "t")
    with pytest.raises(Exception):
        wh.write_full(spark.range(5).selectExpr("assert_true(id < 4)", "id"), "gold", "t")
    assert wh.read("gold", "t").count() == 3
    wh.write_full(spark.range(5), "gold", "t")
    assert wh.read("gold", "t").count() == 5
    wh.write_full(spark.range(0), "gold", "t")
    assert wh.exists("gold", "t") and wh.read("gold", "t").count() == 0
    assert os.listdir(os.path.join(scratch, "gold")) == ["t"]  # nothing stays of former ones
    wh.drop()
    assert not os.path.exists(os.path.join(scratch, "gold"))


def test_full_refresh_replaces_the_stored_loads(spark, scratch):
    wh, tables = Warehouse(spark, scratch), DriverTables(spark, SF)
    for batch in (1, 2):
        load(wh, tables, batch)
    sources = {"customers": tables.customers(3)}
    for _ in range(2):                            # also when run again
        run_batch(wh, sources, stamp(3), 3, full_refresh=True)
        assert wh.batch_ids("silver", SAT) == wh.batch_ids("silver", HUB) == [3]
        assert wh.read("silver", SAT).count() == wh.read("silver", HUB).count() == 150
    run_batch(wh, sources, "2021-01-01 00:00:00", 4)
    assert wh.read_batch("silver", SAT, 4).count() == 0
    assert wh.read("silver", SAT).count() == 150


def test_an_interrupted_full_refresh_changes_nothing(spark, scratch, whole):
    wh, tables = Warehouse(spark, os.path.join(scratch, "wh")), DriverTables(spark, SF)
    for batch in (1, 2, 3):
        load(wh, tables, batch)
    bad = wh.read("silver", SAT).filter("assert_true(credit_score < 0) IS NULL")
    with pytest.raises(Exception):
        wh.write_batch(bad, "silver", SAT, 4, full_refresh=True, key="customer_hub_key")
    assert history(wh) == whole and spark.catalog.tableExists(wh.table("silver", SAT + NEXT))
    run_batch(wh, {"customers": tables.customers(3)}, stamp(3), 4, full_refresh=True)
    assert wh.batch_ids("silver", SAT) == [4] and wh.read("silver", SAT).count() == 150


DOCUMENTED = """
select c.city, d.year, d.quarter, sum(f.amount_usd) as total_spend
from {p}gold.fact_transactions f
join {p}gold.dim_customer c on c.customer_hub_key = f.customer_hub_key and c.is_current
join {p}gold.dim_date d on d.date_key = f.date_key
group by c.city, d.year, d.quarter
order by d.year, d.quarter, c.city"""


def test_the_documented_query_runs_by_name(spark, warehouse_sf0001):
    from tessera.plans.queries import registry
    got = spark.sql(DOCUMENTED.format(p=warehouse_sf0001.prefix)).collect()
    want = registry()["spend_by_city_quarter"](spark, SF).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(got) > 100


def test_many_loads_with_few_snapshots(spark, scratch):
    from tessera.plans import pipeline
    wh, tables = Warehouse(spark, scratch), DriverTables(spark, SF)
    extracts = [tables.customers(b) for b in (1, 2, 3)]
    for n in range(1, 12):
        run_batch(wh, {"customers": extracts[n % 3]}, f"20{10 + n}-01-01 00:00:00", n)
    snapshots = wh.batch_ids(STATE, SAT)
    assert snapshots == [1, 1 + pipeline.SNAPSHOT_EVERY]
    state = pipeline.current_state(wh, pipeline_spec(), 12)
    from tessera.operators.vault import latest_version
    key = pipeline_spec().key_col
    want = latest_version(wh.read("silver", SAT).select(*state.columns), key)
    assert sorted(map(tuple, state.collect())) == sorted(map(tuple, want.collect()))
    run_batch(wh, {"customers": extracts[11 % 3]}, "2030-01-01 00:00:00", 12)
    assert wh.read_batch("silver", SAT, 12).count() == 0
    assert wh.batch_ids(STATE, SAT) == snapshots     # an unchanged load writes no state


def pipeline_spec():
    from tessera.plans.models import SAT as SPECS
    return SPECS[SAT]
