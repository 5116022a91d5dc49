"""Raw-source scans with explicit schemas and layer routing."""

from __future__ import annotations

import os

import pytest

from tessera.operators.bronze import extract_bronze
from tessera.operators.vault import load_hub, load_satellite
from tessera.plans.models import HUB, SAT
from tessera.sources.driver_tables import DriverTables
from tessera.sources.raw import conform, read_source
from tessera.sources.store import Warehouse, layer_name

SF = "/root/testdata/sf0.001"


def test_read_source_parquet_keeps_types_and_csv_gives_the_same_vault(spark, scratch):
    src = DriverTables(spark, SF).customers(3)
    src.write.parquet(os.path.join(scratch, "pq", "customers"))
    src.write.option("header", "true").csv(os.path.join(scratch, "csv", "customers"))
    a = read_source(spark, "customers", os.path.join(scratch, "pq"))
    b = read_source(spark, "customers", os.path.join(scratch, "csv"), fmt="csv")
    assert a.schema == src.schema
    assert dict(b.dtypes)["customer_id"] == "string"

    def vault(df):
        bronze = extract_bronze(df, df.columns, "2020-01-01 00:00:00")
        return [sorted(map(tuple, out.collect())) for out in
                (load_hub(bronze, HUB["hub_customer"]),
                 load_satellite(bronze, SAT["sat_customer_details"]))]
    assert vault(a) == vault(b)


def customers_csv(scratch, *rows):
    folder = os.path.join(scratch, "customers")
    os.makedirs(folder)
    with open(os.path.join(folder, "part.csv"), "w") as f:
        f.write("customer_id,first_name,last_name,email,city,credit_score,created_at\n")
        f.writelines(r + "\n" for r in rows)
    return scratch


def test_text_ids_and_fractional_scores_survive_csv(spark, scratch):
    base = customers_csv(scratch, "C001,a,b,e,x,712.7,2019-01-01", "007,a,b,e,x,712.5,2019-01-01",
                         "7,a,b,e,x,,2019-01-01")
    df = read_source(spark, "customers", base, fmt="csv")
    bronze = extract_bronze(df, df.columns, "2020-01-01 00:00:00")
    hub = load_hub(bronze, HUB["hub_customer"])
    assert sorted(r.customer_id for r in hub.collect()) == ["007", "7", "C001"]
    assert bronze.filter("credit_score = 712.7").count() == 1     # bronze passes values through
    sat = load_satellite(bronze, SAT["sat_customer_details"])
    assert sorted(r.credit_score for r in sat.filter("credit_score IS NOT NULL").collect()) \
        == [713, 713]


@pytest.mark.parametrize("row", ["1,a,b,e,x,abc,2019-01-01", "1,a,b,e,x,700,someday"])
def test_a_bad_csv_value_fails(spark, scratch, row):
    df = read_source(spark, "customers", customers_csv(scratch, row), fmt="csv")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|FAILED_READ"):
        df.collect()


def test_conform_drops_extras_keeps_types_and_rejects_missing(spark):
    df = spark.createDataFrame([(1, "m", "c", "x")],
                               "merchant_id int, merchant_name string, city string, extra string")
    out = conform(df, "merchants")
    assert out.columns == ["merchant_id", "merchant_name", "city"]
    assert dict(out.dtypes)["merchant_id"] == "int"
    with pytest.raises(ValueError):
        conform(df.drop("city"), "merchants")


def test_layer_routing(spark, scratch):
    assert layer_name(None, "main") == "main"
    assert layer_name("  gold ", "main") == "gold"
    wh = Warehouse(spark, scratch, layers={"gold": " marts "})
    assert wh.table("gold", "dim_x").endswith("_marts`.`dim_x`")
    assert wh.table("silver", "hub_x").endswith("_silver`.`hub_x`")
    assert Warehouse(spark, scratch + "/p", prefix="plain_").table("gold", "t") == "`plain_gold`.`t`"
    with pytest.raises(ValueError, match="prefix"):
        Warehouse(spark, scratch + "/q", prefix="plain_").table("gold", "t")
