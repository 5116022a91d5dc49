"""The warehouse build: bronze → silver (incremental) → gold → checks.

``run_batch`` is one load: every extracted source is written to bronze
(full refresh), then every hub, link and satellite fed by those sources
appends its new rows as partition ``_batch=<n>``; the stored state it
compares against is the partitions before ``n``, so re-running a load
rewrites the same partition with the same rows.  ``build_gold`` rebuilds the
star from silver.  Models of one layer are independent and are submitted
concurrently (Spark runs concurrent jobs from driver threads), like a
multi-threaded model runner; dependent models wait for their inputs.
"""

from __future__ import annotations

import os
import sys
import threading
import time
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor, as_completed
from contextlib import nullcontext

from pyspark.sql import Column, DataFrame, SparkSession

from tessera.operators.bronze import extract_bronze
from tessera.operators.checks import CheckSpec, count_failures, enforce, run_checks
from tessera.operators.vault import (
    SatSpec,
    latest_version,
    load_hub,
    load_link,
    load_satellite,
    stored_of_extract,
)
from tessera.plans import gold
from tessera.plans.check_specs import CHECK_SPECS
from tessera.plans.models import (
    BRONZE,
    BRONZE_COLUMNS,
    GOLD_DIMS,
    GOLD_FACTS,
    HUB,
    HUBS,
    LINK,
    LINKS,
    SAT,
    SATELLITES,
    SILVER_MODELS,
    silver_for_source,
)
from tessera.schemas import RECORD_SOURCE
from tessera.session import dropping_shuffles
from tessera.sources.driver_tables import BATCH_SOURCES, DriverTables, stamp
from tessera.sources.store import Warehouse

DEFAULT_THREADS = 8


def _traced(name: str, fn: Callable[[], None]) -> Callable[[], None]:
    """Wrap a model write; with TESSERA_TRACE set, print its wall time."""
    if not os.environ.get("TESSERA_TRACE"):
        return fn

    def run() -> None:
        t = time.perf_counter()
        fn()
        print(f"[tessera] {name}: {time.perf_counter() - t:.2f}s", file=sys.stderr)
    return run


def _run_all(tasks: Iterable[Callable[[], None]], threads: int) -> None:
    tasks = list(tasks)
    if threads <= 1 or len(tasks) <= 1:
        for t in tasks:
            t()
        return
    with ThreadPoolExecutor(max_workers=threads) as pool:
        for f in [pool.submit(t) for t in tasks]:
            f.result()


# ---------------------------------------------------------------------------
# bronze + silver
# ---------------------------------------------------------------------------
def load_bronze(wh: Warehouse, sources: Mapping[str, DataFrame], loaded_at: Column | str,
                record_source: str = RECORD_SOURCE, threads: int = DEFAULT_THREADS) -> None:
    def task(src: str, df: DataFrame) -> Callable[[], None]:
        return _traced(BRONZE[src], lambda: wh.write_full(
            extract_bronze(df, BRONZE_COLUMNS[src], loaded_at, record_source),
            "bronze", BRONZE[src]))
    _run_all([task(s, d) for s, d in sources.items()], threads)


def silver_tasks(wh: Warehouse, sources: Iterable[str], batch: int,
                 full_refresh: bool = False) -> list[Callable[[], None]]:
    """One task per hub, link and satellite fed by ``sources``.  With ``full_refresh`` a model
    starts anew from this load, as if nothing were stored."""
    tasks: list[Callable[[], None]] = []
    for src in sources:
        hubs, links, sats = silver_for_source(src)
        bronze = wh.read("bronze", BRONZE[src])   # resolved once, shared by the models
        for spec in [*hubs, *links, *sats]:
            tasks.append(_traced(spec.name, lambda name=spec.name, bronze=bronze:
                                 silver_task(wh, name, batch, bronze, full_refresh)))
    return tasks


def silver_task(wh: Warehouse, name: str, batch: int, bronze: DataFrame,
                full_refresh: bool = False) -> None:
    """Append load ``batch``, whose extract is ``bronze``, to a hub, link or satellite."""
    if name in SAT:
        satellite_task(wh, SAT[name], batch, bronze, full_refresh)
        return
    if name in HUB:
        load, spec, key, ids = load_hub, HUB[name], HUB[name].key_col, [HUB[name].id_col]
    else:
        load, spec, key, ids = load_link, LINK[name], LINK[name].dealt_by, LINK[name].dealt_ids
    stored = None if full_refresh else stored_of_extract(
        wh.read_before("silver", name, batch), bronze, key, ids, wh.buckets,
        # the same ids, so that one shuffle serves both
        sighted=name in HUB or set(ids) == {i for _, i in LINK[name].hubs})
    wh.write_batch(load(bronze, spec, stored, buckets=wh.buckets), "silver", name, batch,
                   full_refresh, key=key, dealt=True)


STATE = "state"       # layer of the current-version snapshots
SNAPSHOT_EVERY = 8    # loads per snapshot; the loads since then are read beside it


def current_state(wh: Warehouse, spec: SatSpec, batch: int,
                  needed: Callable[[DataFrame], DataFrame] = lambda stored: stored,
                  ) -> DataFrame | None:
    """Latest (key, load_date, hashdiff) per key as seen by load ``batch``: the newest earlier
    snapshot and the rows appended since, or the whole history where there is no snapshot.
    ``needed`` restricts the stored rows to keys of interest."""
    cols = [spec.key_col, "load_date", "hashdiff"]
    snap = wh.max_batch(STATE, spec.name, batch)
    since = wh.read_before("silver", spec.name, batch, after=snap)
    if since is not None:
        since = needed(since.select(*cols))
    if snap is None:
        return None if since is None else latest_version(since, spec.key_col)
    state = needed(wh.read_batch(STATE, spec.name, snap).select(*cols))
    return state if since is None else latest_version(state.unionByName(since), spec.key_col)


def satellite_task(wh: Warehouse, spec: SatSpec, batch: int, bronze: DataFrame | None = None,
                   full_refresh: bool = False) -> None:
    """Append load ``batch`` to a satellite; for snapshot satellites, record the current state
    at every ``SNAPSHOT_EVERY``-th load."""
    if bronze is None:
        bronze = wh.read("bronze", BRONZE[spec.source])

    def needed(stored: DataFrame | None) -> DataFrame | None:
        return stored_of_extract(stored, bronze, spec.key_col, [spec.id_col], wh.buckets)

    if not spec.snapshot:
        stored = None if full_refresh else needed(wh.read_before("silver", spec.name, batch))
        wh.write_batch(load_satellite(bronze, spec, stored, buckets=wh.buckets), "silver", spec.name,
                       batch, full_refresh, key=spec.key_col, dealt=True)
        return
    # a snapshot of an earlier run of this load, or of a later one, does not describe what is
    # written now
    for stale in wh.batch_ids(STATE, spec.name):
        if stale >= batch or full_refresh:
            wh.drop_batch(STATE, spec.name, stale)
    state = None if full_refresh else current_state(wh, spec, batch, needed)
    wh.write_batch(load_satellite(bronze, spec, state, latest_only=True, buckets=wh.buckets), "silver",
                   spec.name, batch, full_refresh, key=spec.key_col, dealt=True)
    snapshots = wh.batch_ids(STATE, spec.name)
    loads = wh.batch_ids("silver", spec.name)
    if snapshots and len([b for b in loads if b > snapshots[-1]]) < SNAPSHOT_EVERY:
        return
    wh.write_batch(current_state(wh, spec, batch + 1), STATE, spec.name, batch, key=spec.key_col)
    for old in snapshots[:-1]:
        wh.drop_batch(STATE, spec.name, old)


def run_batch(wh: Warehouse, sources: Mapping[str, DataFrame], loaded_at: Column | str,
              batch: int, threads: int = DEFAULT_THREADS,
              record_source: str = RECORD_SOURCE, full_refresh: bool = False) -> None:
    """One load.  Each source's silver models start as soon as *its* bronze
    table is written (no barrier across sources), so a large extract does not
    hold back the models of the small ones.  ``threads`` bounds the jobs of the
    whole load."""
    def bronze(src: str, df: DataFrame) -> Callable[[], None]:
        return _traced(BRONZE[src], lambda: wh.write_full(
            extract_bronze(df, BRONZE_COLUMNS[src], loaded_at, record_source),
            "bronze", BRONZE[src]))

    with ThreadPoolExecutor(max_workers=max(threads, 1)) as pool:
        written = {pool.submit(bronze(s, d)): s for s, d in sources.items()}
        silver = []
        for done in as_completed(written):
            done.result()
            silver += [pool.submit(t)
                       for t in silver_tasks(wh, [written[done]], batch, full_refresh)]
        for f in silver:
            f.result()


def run_silver(wh: Warehouse, sources: Iterable[str], batch: int,
               threads: int = DEFAULT_THREADS, full_refresh: bool = False) -> None:
    """Load silver alone, from the bronze tables as they are stored."""
    _run_all(silver_tasks(wh, sources, batch, full_refresh), threads)


# ---------------------------------------------------------------------------
# gold
# ---------------------------------------------------------------------------
def gold_model(wh: Warehouse, name: str) -> DataFrame:
    s = lambda n: wh.read("silver", n)
    g = lambda n: wh.read("gold", n)
    builders: dict[str, Callable[[], DataFrame]] = {
        "dim_date": lambda: gold.dim_date(wh.spark),
        "dim_branch": lambda: gold.dim_branch(s("sat_branch_details"), s("hub_branch")),
        "dim_merchant": lambda: gold.dim_merchant(s("sat_merchant_details"), s("hub_merchant")),
        "dim_card": lambda: gold.dim_card(s("sat_card_details"), s("hub_card"),
                                          s("link_account_card")),
        "dim_account": lambda: gold.dim_account(s("sat_account_details"), s("hub_account"),
                                                s("link_customer_account")),
        "fact_transactions": lambda: gold.fact_transactions(
            s("link_account_merchant"), s("sat_transaction_details"), s("link_customer_account")),
        "fact_loans": lambda: gold.fact_loans(s("link_customer_loan"), s("sat_loan_details")),
        "fact_account_balance": lambda: gold.fact_account_balance(
            s("sat_account_details"), s("link_customer_account")),
        # the only gold → gold edges: built after dim_account and fact_loans
        "dim_customer": lambda: gold.dim_customer(
            s("sat_customer_details"), s("hub_customer"), g("dim_account"), g("fact_loans")),
    }
    return builders[name]()


def gold_slices(wh: Warehouse, name: str, slices: int) -> list:
    """What `write_full` writes of a gold model: fact_transactions, whose rows are shuffled to their
    accounts, in ``slices`` by the account, so that a slice's shuffle is on disk at a time (by the
    transaction slices would be read faster, but the accounts' links be shuffled for each, and the rows
    of an account lie apart, of which codecs shrink less)."""
    if name != "fact_transactions" or slices == 1:
        return [gold_model(wh, name), "gold", name]
    link, sat, owners = (wh.read("silver", m) for m in GOLD_READS[name])
    first, *more = [gold.fact_transactions(link.filter(c), sat, owners.filter(c))
                    for c in gold.key_slices("account_hub_key", slices)]
    return [first, "gold", name, *more]


# gold models that read other gold models
GOLD_DEPENDS = {"dim_customer": ("dim_account", "fact_loans")}
# silver models that gold models read
GOLD_READS = {
    "dim_date": (),
    "dim_branch": ("sat_branch_details", "hub_branch"),
    "dim_merchant": ("sat_merchant_details", "hub_merchant"),
    "dim_card": ("sat_card_details", "hub_card", "link_account_card"),
    "dim_account": ("sat_account_details", "hub_account", "link_customer_account"),
    "dim_customer": ("sat_customer_details", "hub_customer"),
    "fact_transactions": ("link_account_merchant", "sat_transaction_details",
                          "link_customer_account"),
    "fact_loans": ("link_customer_loan", "sat_loan_details"),
    "fact_account_balance": ("sat_account_details", "link_customer_account"),
}


def build_gold(wh: Warehouse, threads: int = DEFAULT_THREADS) -> None:
    """Rebuild every gold model; a model starts as soon as the gold models it
    reads are written (the others run concurrently from the start)."""
    def write(m: str) -> Callable[[], None]:
        return _traced(m, lambda: wh.write_full(gold_model(wh, m), "gold", m))

    models = GOLD_DIMS + GOLD_FACTS
    with ThreadPoolExecutor(max_workers=max(threads, 1)) as pool:
        futures = {m: pool.submit(write(m)) for m in models if m not in GOLD_DEPENDS}
        for m, deps in GOLD_DEPENDS.items():
            for d in deps:
                futures[d].result()
            futures[m] = pool.submit(write(m))
        for f in futures.values():
            f.result()


# ---------------------------------------------------------------------------
# checks
# ---------------------------------------------------------------------------
def model_tables(wh: Warehouse, threads: int = 8) -> dict[str, DataFrame]:
    """Every stored model by name (bronze, silver, gold).  Resolving a table
    lists its files and reads a footer on the driver, so it is done
    concurrently."""
    wanted = ([("bronze", n) for n in BRONZE.values()]
              + [("silver", s.name) for s in [*HUBS, *LINKS, *SATELLITES]]
              + [("gold", n) for n in GOLD_DIMS + GOLD_FACTS])

    def resolve(item: tuple[str, str]) -> tuple[str, DataFrame | None]:
        layer, name = item
        return name, (wh.read(layer, name) if wh.exists(layer, name) else None)

    with ThreadPoolExecutor(max_workers=threads) as pool:
        found = list(pool.map(resolve, wanted))
    return {name: df for name, df in found if df is not None}


def dealt_by(wh: Warehouse, models: Iterable[str | None] = SILVER_MODELS) -> dict[str, str]:
    """The columns that stored models are bucketed by."""
    silver = [m for m in models if m in SILVER_MODELS and wh.exists("silver", m)]
    found = {m: wh.dealt_by("silver", m) for m in silver}
    return {m: c for m, c in found.items() if c}


def source_tables(tables: DriverTables, batch: int = 3) -> dict[str, DataFrame]:
    """The raw sources of one load, keyed like the source checks expect."""
    return {f"source_{n}": df for n, df in tables.batch(batch).items()}


def layer_of(model: str) -> str:
    if model.startswith("source_"):
        return "source"
    if model.startswith("bronze_"):
        return "bronze"
    if model.startswith(("hub_", "link_", "sat_")):
        return "silver"
    return "gold"


def run_data_checks(wh: Warehouse, extra: Mapping[str, DataFrame] | None = None,
                    specs=CHECK_SPECS, layers: Iterable[str] | None = None) -> DataFrame:
    """Summary of the catalogue's checks on the stored models (+ ``extra``
    tables such as the raw sources), optionally only those of ``layers``."""
    tables = {**model_tables(wh), **(extra or {})}
    wanted = set(layers) if layers is not None else None
    usable = [s for s in specs if s.model in tables and (s.to is None or s.to in tables)
              and (wanted is None or layer_of(s.model) in wanted)]
    return run_checks(tables, usable, dealt_by(wh, {s.model for s in usable} | {s.to for s in usable}),
                      at_once(wh.sizes()))


# ---------------------------------------------------------------------------
# whole build from the driver tables
# ---------------------------------------------------------------------------
def build_warehouse(spark: SparkSession, sf_dir: str, root: str,
                    batches: Iterable[int] = (1, 2, 3), threads: int = DEFAULT_THREADS,
                    gate: bool = False) -> Warehouse:
    """Load the batches, then rebuild gold.  With ``gate``, failed checks block
    what is downstream of them: source, bronze and silver checks must pass
    before gold is built, and the gold checks after it (DataQualityError)."""
    wh = Warehouse(spark, root)
    tables = DriverTables(spark, sf_dir)
    with dropping_shuffles(spark):
        for b in batches:
            run_batch(wh, tables.batch(b), stamp(b), b, threads=threads)
    if gate:
        enforce(run_data_checks(wh, source_tables(tables),
                                layers=("source", "bronze", "silver")))
    with dropping_shuffles(spark):
        build_gold(wh, threads=threads)
    if gate:
        enforce(run_data_checks(wh, layers=("gold",)))
    return wh


def upstream(model: str) -> list[str]:
    """The models that ``model`` reads."""
    if model in GOLD_READS:
        return [*GOLD_READS[model], *GOLD_DEPENDS.get(model, ())]
    if model in BRONZE.values():
        return []
    return [BRONZE[{**HUB, **LINK, **SAT}[model].source]]


def with_upstream(models: Iterable[str], built: Iterable[str] = ()) -> list[str]:
    """``models`` and all that they are built from, what is read before what reads it; without those
    in ``built`` and what these alone are built from."""
    order: dict[str, None] = {}
    there = set(built)

    def visit(model: str) -> None:
        if model in there:
            return
        for m in upstream(model):
            visit(m)
        order.setdefault(model)

    for model in models:
        visit(model)
    return sorted(order, key=lambda m: ["bronze", "silver", "gold"].index(layer_of(m)))


def build_steps(models: Iterable[str]) -> list[list[str]]:
    """``models`` as they are built where disk is short: source after source (transactions last) its
    bronze and silver, then the gold models that need no further source."""
    left = set(models)
    sources: dict[str, set[str]] = {}

    def fed_by(model: str) -> set[str]:
        if model not in sources:
            sources[model] = ({model} if model in BRONZE.values()
                              else set().union(*[fed_by(m) for m in upstream(model)]))
        return sources[model]

    steps, seen = [], set()
    for bronze in BRONZE.values():
        seen.add(bronze)
        now = [m for m in [*BRONZE.values(), *SILVER_MODELS] if m in left and fed_by(m) == {bronze}]
        ready = [m for m in [*GOLD_DIMS, *GOLD_FACTS] if m in left and fed_by(m) <= seen]
        late = [m for m in ready if m in GOLD_DEPENDS]
        for step in (now, [m for m in ready if m not in late], late):
            left -= set(step)
            if step:
                steps.append(step)
    return steps


#: Bytes of files beyond which a table that nothing reads any more is dropped, if no query named it,
#: and a model that reads it is built when no other such is.
LARGE = 32 << 20
#: Slices that a fact is built in if it reads a large table.
SLICES = 4


def at_once(sizes: Mapping[tuple[str, str], int], threads: int = DEFAULT_THREADS) -> int:
    """How many models to build or check at a time beside tables of these sizes."""
    return threads if sum(sizes.values()) <= LARGE else 1


def build_models(wh: Warehouse, tables: DriverTables, models: Iterable[str], built: set[str],
                 threads: int = DEFAULT_THREADS, keep: set[str] | None = None,
                 written: Callable[[list[str], int], None] | None = None,
                 read_later: Callable[[], set[str]] = set) -> None:
    """Build ``models`` and all that they are built from, of every load, but those in ``built``, to
    which they are added.  The rows are those of `build_warehouse`.  A source's extract of each load
    is written once and stays (the newest in bronze, the ones before beside it), so that models can
    be added later; a model starts when those it reads are written.

    With ``keep`` bronze is built first; if it is large, the other models in steps (`build_steps`).  Large
    tables of others than those in ``keep`` go, also from ``built``, once nothing to be built reads
    them; what is asked for later is built again, of the same rows.  ``written`` is called with what is stored after each
    step, for instance to check it, and how many tables to take at a time; what ``read_later`` tells is read by later such calls and stays."""
    loads = {src: [b for b, names in BATCH_SOURCES.items() if src in names] for src in BRONZE}
    source = {name: src for src, name in BRONZE.items()}
    alone = threading.Lock()
    sizes: dict[tuple[str, str], int] = {}

    def layer(src: str, b: int) -> str:
        return "bronze" if b == loads[src][-1] else f"bronze_{b}"

    def stored(model: str) -> list[str]:
        """The layers that hold a model."""
        return [layer(source[model], b) for b in loads[source[model]]] if model in source else [layer_of(model)]

    def large(model: str) -> bool:
        return sum(sizes.get((wh.layers.get(at) or at, model), 0) for at in stored(model)) > LARGE

    def build(model: str) -> None:
        if model in source:
            src = source[model]
            for b in loads[src]:
                wh.write_full(extract_bronze(tables.source(src, b), BRONZE_COLUMNS[src], stamp(b)),
                              layer(src, b), model)
        elif layer_of(model) == "silver":
            src = source[upstream(model)[0]]
            for b in loads[src]:
                silver_task(wh, model, b, wh.read(layer(src, b), BRONZE[src]))
            if model in SAT and SAT[model].snapshot:
                # for loads to come; if one does come it reads the history
                for b in wh.batch_ids(STATE, model):
                    wh.drop_batch(STATE, model, b)
        else:
            slices = SLICES if any(large(m) for m in upstream(model)) else 1
            wh.write_full(*gold_slices(wh, model, slices))

    def run(missing: list[str]) -> None:
        futures: dict = {}

        def after_upstream(model: str) -> None:
            for m in upstream(model):  # submitted before, so that a thread has it
                if m in futures:
                    futures[m].result()
            with alone if any(large(m) for m in upstream(model)) else nullcontext():
                _traced(model, lambda: build(model))()

        # dim_customer reads other gold models and goes last
        missing.sort(key=lambda m: m in GOLD_DEPENDS)
        with dropping_shuffles(wh.spark), ThreadPoolExecutor(max_workers=max(threads, 1)) as pool:
            for m in missing:
                futures[m] = pool.submit(after_upstream, m)
        for m, f in futures.items():
            if f.exception() is None:
                built.add(m)
        for f in futures.values():
            f.result()

    missing = with_upstream(models, built)
    if keep is None:
        run(missing)
        return
    if not missing:
        return
    run([m for m in missing if m in source])
    sizes = wh.sizes()
    rest = [m for m in missing if m not in source]
    steps = [rest] if at_once(sizes, threads) > 1 else build_steps(rest)
    for k, step in enumerate([[], *steps]):
        run(step)
        sizes = wh.sizes()
        if written:
            written(sorted(built), at_once(sizes, threads))
        needed = keep | read_later() | {u for later in steps[k:] for m in later for u in upstream(m)}
        for m in sorted(built - needed):
            if large(m):
                built.discard(m)
                for at in stored(m):
                    wh.drop_table(at, m)


def check_models(wh: Warehouse, tables: DriverTables, specs: Sequence[CheckSpec], built: set[str],
                 keep: set[str], threads: int = DEFAULT_THREADS) -> list[int]:
    """Failures of each of ``specs`` in the models that they name, which are built, and in the sources.
    A model is checked once it and its parents are stored, before later models are built, so
    that large tables that neither a later model nor a later check reads can go."""
    specs = list(specs)
    failures: dict[int, int] = {}
    raw = source_tables(tables)

    def needs(spec: CheckSpec) -> set[str]:
        return {m for m in (spec.model, spec.to) if m and m not in raw}

    def check(stored: Iterable[str], at_a_time: int) -> None:
        there = set(stored)
        now = [i for i, s in enumerate(specs) if i not in failures and needs(s) <= there]
        found = {m: wh.read(layer_of(m), m) for i in now for m in needs(specs[i])}
        dealt = dealt_by(wh, found)
        failures.update(zip(now, count_failures({**found, **raw}, [specs[i] for i in now], dealt, at_a_time),
                            strict=True))

    def read_later() -> set[str]:
        return {m for i, s in enumerate(specs) if i not in failures for m in needs(s)}

    check(built, threads if not built else at_once(wh.sizes(), threads))
    build_models(wh, tables, sorted(read_later()), built, threads, keep, check, read_later)
    return [failures[i] for i in range(len(specs))]


__all__ = [
    "BATCH_SOURCES",
    "layer_of",
    "build_gold",
    "build_models",
    "build_warehouse",
    "check_models",
    "dealt_by",
    "gold_model",
    "load_bronze",
    "model_tables",
    "run_batch",
    "run_data_checks",
    "run_silver",
    "source_tables",
    "with_upstream",
]
