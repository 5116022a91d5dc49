"""Command line: run the warehouse build the way the layers are run.

    python -m tessera build  --root R --batch 3 --raw-dir D [--format csv]
    python -m tessera load   --root R --batch 3 --sf-dir /root/testdata/sf0.01 [--layer bronze]
    python -m tessera gold   --root R
    python -m tessera test   --root R [--layer silver]

``load`` writes bronze and appends silver for one batch (``--layer bronze``
stops after bronze, ``--layer silver`` loads silver from the stored bronze;
``--full-refresh`` starts silver anew from this batch); ``gold`` rebuilds the star; ``test`` prints the check
summary and exits 1 when a check fails; ``build`` = load, upstream checks,
gold, gold checks — a failed check stops the build.  ``--gate`` does the same for one
layer: ``load --gate`` fails on the checks of what it has loaded, ``gold --gate`` builds
nothing while a silver check fails, and then checks gold.  Raw tables come from
``--raw-dir`` (``<dir>/<table>``, any reader format, declared schemas) or,
for the bundled test data, from ``--sf-dir`` and the batch number.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from tessera.operators.checks import DataQualityError, enforce
from tessera.plans.pipeline import (
    build_gold,
    load_bronze,
    run_batch,
    run_data_checks,
    run_silver,
    source_tables,
)
from tessera.plans.models import BRONZE
from tessera.schemas import SOURCE_NAMES
from tessera.session import configure_session, scratch_root
from tessera.sources.driver_tables import BATCH_STAMPS, DriverTables
from tessera.sources.raw import read_source
from tessera.sources.store import Warehouse

LAYERS = {"source": ("source",), "bronze": ("bronze",), "silver": ("silver",),
          "gold": ("gold",), "all": None}


def _sources(spark: SparkSession, args) -> dict:
    if args.sf_dir:
        return DriverTables(spark, args.sf_dir).batch(args.batch)
    names = args.tables.split(",") if args.tables else SOURCE_NAMES
    return {n: read_source(spark, n, args.raw_dir, fmt=args.format) for n in names}


def _loaded_at(args) -> str | None:
    if args.loaded_at:
        return args.loaded_at
    if args.sf_dir:
        return BATCH_STAMPS[args.batch]
    return None  # the session's current local time, one constant per extract


def _check(spark, wh, args, layers) -> int:
    extra = source_tables(DriverTables(spark, args.sf_dir), args.batch) \
        if args.sf_dir and args.batch else None
    summary = run_data_checks(wh, extra, layers=layers)
    rows = summary.collect()  # one row per check
    failed = [r for r in rows if r.failures]
    for r in rows:
        print(f"{'FAIL' if r.failures else 'PASS'} {r.check_id} {r.failures}")
    print(f"{len(rows) - len(failed)} passed, {len(failed)} failed")
    return 1 if failed else 0


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tessera")
    p.add_argument("command", choices=["load", "gold", "test", "build"])
    p.add_argument("--root", help="warehouse folder (default: under spark.checkpoint.dir)")
    p.add_argument("--prefix", default="", help="prefix of the databases bronze, silver and gold")
    p.add_argument("--batch", type=int, help="load number (increasing)")
    p.add_argument("--loaded-at", help="load stamp 'YYYY-MM-DD HH:MM:SS' (UTC)")
    p.add_argument("--raw-dir", help="folder with one sub-folder per raw table")
    p.add_argument("--format", default="parquet", help="reader format of --raw-dir")
    p.add_argument("--tables", help="comma-separated raw tables to extract (default: all)")
    p.add_argument("--sf-dir", help="test-data folder (derives the raw tables per batch)")
    p.add_argument("--layer", default="all", choices=list(LAYERS))
    p.add_argument("--full-refresh", action="store_true",
                   help="load/build: replace stored silver by this batch alone")
    p.add_argument("--gate", action="store_true", help="load/gold: run the layer's own checks, exit 1 on failure")
    args = p.parse_args(argv)

    spark = configure_session(SparkSession.builder.appName("tessera").getOrCreate())
    wh = Warehouse(spark, args.root or f"{scratch_root(spark)}/tessera-warehouse", prefix=args.prefix)
    silver_only = args.command == "load" and args.layer == "silver"
    if args.command == "load" and args.layer in ("source", "gold"):
        p.error("load takes --layer bronze, silver or all")
    if args.command in ("load", "build") and (
            args.batch is None or not (args.raw_dir or args.sf_dir or silver_only)):
        p.error("load/build need --batch and --raw-dir or --sf-dir")
    try:
        return _run(spark, wh, args, silver_only)
    except DataQualityError as e:
        print(e, file=sys.stderr)
        return 1


def _gate(wh: Warehouse, *layers: str, extra=None) -> None:
    enforce(run_data_checks(wh, extra, layers=layers))


def _run(spark: SparkSession, wh: Warehouse, args, silver_only: bool) -> int:
    if silver_only:
        stored = [n for n in (args.tables.split(",") if args.tables else SOURCE_NAMES)
                  if wh.exists("bronze", BRONZE[n])]
        if args.gate:
            _gate(wh, "bronze")
        run_silver(wh, stored, args.batch, full_refresh=args.full_refresh)
        if args.gate:
            _gate(wh, "silver")
        return 0
    if args.command == "load":
        srcs = _sources(spark, args)
        if args.layer == "bronze":
            load_bronze(wh, srcs, _loaded_at(args))
        else:
            run_batch(wh, srcs, _loaded_at(args), args.batch, full_refresh=args.full_refresh)
        if args.gate:
            _gate(wh, "bronze", *(["silver"] if args.layer != "bronze" else []))
        return 0
    if args.command == "gold":
        if args.gate:
            _gate(wh, "silver")
        build_gold(wh)
        if args.gate:
            _gate(wh, "gold")
        return 0
    if args.command == "test":
        return _check(spark, wh, args, LAYERS[args.layer])
    # build: failed upstream checks block gold
    run_batch(wh, _sources(spark, args), _loaded_at(args), args.batch,
              full_refresh=args.full_refresh)
    extra = source_tables(DriverTables(spark, args.sf_dir), args.batch) if args.sf_dir else None
    _gate(wh, "source", "bronze", "silver", extra=extra)
    build_gold(wh)
    _gate(wh, "gold")
    print("build complete")
    return 0


if __name__ == "__main__":
    sys.exit(main())
