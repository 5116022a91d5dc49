"""Streaming front end: landed extracts load incrementally, once each."""

from __future__ import annotations

import json
import os

from tessera.plans.pipeline import run_batch
from tessera.sources.driver_tables import DriverTables, stamp
from tessera.sources.store import Warehouse
from tessera.streaming.landing import run_extracts_once, run_landing_once

SF = "/root/testdata/sf0.001"


def test_landed_extracts_load_incrementally(spark, scratch):
    t = DriverTables(spark, SF)
    landing = os.path.join(scratch, "landing")
    wh = Warehouse(spark, os.path.join(scratch, "wh"))
    ckpt = os.path.join(scratch, "streams")

    t.customers(1).write.mode("append").parquet(os.path.join(landing, "customers"))
    run_landing_once(spark, wh, landing, ["customers"], base_batch=100, checkpoint_dir=ckpt)
    assert wh.read("silver", "hub_customer").count() == 113
    assert wh.read("silver", "sat_customer_details").count() == 113

    # a second extract lands: only its new keys / changed versions append
    t.customers(2).write.mode("append").parquet(os.path.join(landing, "customers"))
    run_landing_once(spark, wh, landing, ["customers"], base_batch=100, checkpoint_dir=ckpt)
    assert wh.read("silver", "hub_customer").count() == 150
    assert wh.read("silver", "sat_customer_details").count() == 113 + 60

    # nothing new landed: nothing is reloaded
    run_landing_once(spark, wh, landing, ["customers"], base_batch=100, checkpoint_dir=ckpt)
    assert wh.read("silver", "sat_customer_details").count() == 173


def test_an_extract_of_many_files_is_one_load(spark, scratch):
    t = DriverTables(spark, SF)
    landing = os.path.join(scratch, "landing")
    wh = Warehouse(spark, os.path.join(scratch, "wh"))
    rows = t.customers(1)
    rows.repartition(1100).write.option("maxRecordsPerFile", 1).parquet(
        os.path.join(landing, "customers"))
    run_landing_once(spark, wh, landing, ["customers"], base_batch=7,
                     checkpoint_dir=os.path.join(scratch, "streams"))
    bronze = wh.read("bronze", "bronze_customers")
    assert bronze.count() == rows.count()
    assert bronze.select("_loaded_at").distinct().count() == 1


def manifest(landing, name, path, loaded_at=None):
    folder = os.path.join(landing, "manifests", "customers")
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, f"{name}.json"), "w") as out:
        json.dump({"path": path} | ({"loaded_at": loaded_at} if loaded_at else {}), out, indent=1)


def test_an_extract_is_loaded_when_its_manifest_lands(spark, scratch):
    t = DriverTables(spark, SF)
    landing, ckpt = os.path.join(scratch, "landing"), os.path.join(scratch, "streams")
    wh = Warehouse(spark, os.path.join(scratch, "wh"))
    os.makedirs(os.path.join(landing, "manifests", "customers"))
    folder = lambda name: os.path.join(landing, "customers", name)
    run = lambda: run_extracts_once(spark, wh, landing, ["customers"], 10, ckpt)

    # half of an extract has landed when the stream runs: nothing is loaded
    rows = t.customers(1)
    rows.filter("customer_id % 2 = 0").write.parquet(folder("first"))
    run()
    assert not wh.exists("bronze", "bronze_customers")
    rows.filter("customer_id % 2 = 1").write.mode("append").parquet(folder("first"))
    manifest(landing, "1", "first", "2016-01-01 00:00:00")
    run()
    bronze = wh.read("bronze", "bronze_customers")
    assert bronze.count() == rows.count() == wh.read("silver", "hub_customer").count()
    assert [str(r[0]) for r in bronze.select("_loaded_at").distinct().collect()] == ["2016-01-01 00:00:00"]

    # two extracts wait: a load each, in order
    t.customers(2).write.parquet(folder("second"))
    t.customers(3).write.parquet(folder("third"))
    manifest(landing, "2", "second", "2018-01-01 00:00:00")
    os.utime(os.path.join(landing, "manifests", "customers", "2.json"), (1.6e9, 1.6e9))
    manifest(landing, "3", "third/")
    run()
    sat = wh.batches("silver", "sat_customer_details").collect()
    whole = Warehouse(spark, os.path.join(scratch, "whole"))
    for batch in (1, 2, 3):
        run_batch(whole, {"customers": t.customers(batch)}, stamp(batch), batch)
    want = whole.batches("silver", "sat_customer_details").collect()
    assert sorted(r.rows_added for r in sat) == sorted(r.rows_added for r in want)
    assert len(wh.batch_ids("silver", "sat_customer_details")) == 3
    run()  # nothing new
    assert len(wh.batch_ids("silver", "sat_customer_details")) == 3
