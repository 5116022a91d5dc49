"""Command line: load / build / test on the sf0.001 tables."""

from __future__ import annotations

import os

from tessera import __main__ as cli
from tessera.sources.store import Warehouse

SF = "/root/testdata/sf0.001"


def main(argv):
    """The command line, with databases of the root's own."""
    root = argv[argv.index("--root") + 1]
    return cli.main([*argv, "--prefix", Warehouse(None, root, buckets=1).prefix])


def test_cli_build_and_test(spark, scratch, capsys):
    root = os.path.join(scratch, "wh")
    assert main(["load", "--root", root, "--batch", "1", "--sf-dir", SF]) == 0
    assert main(["load", "--root", root, "--batch", "2", "--sf-dir", SF]) == 0
    assert main(["build", "--root", root, "--batch", "3", "--sf-dir", SF]) == 0
    wh = Warehouse(spark, root)
    assert wh.read("gold", "dim_customer").count() == 207
    assert main(["test", "--root", root, "--layer", "gold"]) == 0
    assert "0 failed" in capsys.readouterr().out


def test_cli_reads_raw_folder(spark, scratch):
    from tessera.sources.driver_tables import DriverTables
    raw = os.path.join(scratch, "raw")
    DriverTables(spark, SF).customers(3).write.option("header", "true").csv(
        os.path.join(raw, "customers"))
    root = os.path.join(scratch, "wh")
    assert main(["load", "--root", root, "--batch", "1", "--raw-dir", raw, "--format", "csv",
                 "--tables", "customers", "--loaded-at", "2020-01-01 00:00:00"]) == 0
    assert Warehouse(spark, root).read("silver", "hub_customer").count() == 150


def test_cli_silver_alone_and_full_refresh(spark, scratch):
    root = os.path.join(scratch, "wh")
    wh = Warehouse(spark, root)
    assert main(["load", "--root", root, "--batch", "1", "--sf-dir", SF, "--layer", "bronze"]) == 0
    assert not wh.exists("silver", "hub_customer")
    assert main(["load", "--root", root, "--batch", "1", "--layer", "silver"]) == 0
    assert wh.read("silver", "hub_customer").count() == 113
    assert main(["load", "--root", root, "--batch", "2", "--sf-dir", SF, "--full-refresh"]) == 0
    assert wh.batch_ids("silver", "sat_customer_details") == [2]
    assert wh.read("silver", "sat_customer_details").count() == 150


def test_gate_stops_the_next_layer(spark, scratch, capsys):
    from tessera.sources.driver_tables import DriverTables
    root = os.path.join(scratch, "wh")
    load = ["load", "--root", root, "--sf-dir", SF, "--gate", "--batch"]
    # batch 1 has two sources of seven; their checks pass
    assert main([*load, "1"]) == 0
    assert main(["load", "--root", root, "--sf-dir", SF, "--batch", "3"]) == 0
    wh = Warehouse(spark, root)
    # a customer id twice in one extract: the satellite's grain check fails, and gold is not built
    raw = os.path.join(scratch, "raw")
    rows = DriverTables(spark, SF).customers(3).limit(5)
    rows = [rows.withColumn("city", rows.city.substr(1, n)) for n in (2, 3)]
    rows[0].unionByName(rows[1]).write.parquet(os.path.join(raw, "customers"))
    more = ["--batch", "4", "--raw-dir", raw, "--tables", "customers", "--loaded-at", "2022-01-01 00:00:00"]
    assert main(["load", "--root", root, "--gate", *more]) == 1
    assert main(["gold", "--root", root, "--gate"]) == 1
    assert not wh.exists("gold", "fact_transactions")
    assert "sat_customer_details" in capsys.readouterr().err
    wh.drop_batch("silver", "sat_customer_details", 4)
    assert main(["gold", "--root", root, "--gate"]) == 0
    assert wh.exists("gold", "fact_transactions")
