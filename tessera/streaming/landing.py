"""Continuous incremental load: extracts landing in a folder are streamed
into the same bronze → silver load the batch pipeline runs.

Two ways to tell what an extract is, one Structured Streaming query per source
each, with ``foreachBatch``:

* **by manifest** (`start_extract_load`): the files of an extract land in a folder
  of their own, in any number of steps, and a manifest names the folder when it is
  whole.  The stream reads the manifests, one a trigger, and a manifest is one load:
  one stamp, the whole extract in bronze.  A folder without a manifest is not read;
* **by trigger** (`start_landing_load`): what has landed in ``<landing>/<source>/``
  since the previous trigger is one extract.  It suits extracts whose files are
  moved in at once.

A load is partition ``_batch = base + epoch_id``.  Replaying an epoch after a
failure rewrites the same partition, and the stream's own checkpoint (under the
session's checkpoint folder) records what was consumed, so each extract is loaded
once.  The load stamp is the manifest's ``loaded_at``, or else the newest
modification time of the files read by the stream: one constant per extract, and
the same when an epoch is replayed.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tessera.operators.bronze import extract_bronze
from tessera.plans.models import BRONZE, BRONZE_COLUMNS
from tessera.plans.pipeline import DEFAULT_THREADS, _run_all, silver_tasks
from tessera.session import scratch_root
from tessera.sources.raw import conform
from tessera.sources.store import Warehouse

LANDED = "_landed_at"


def _loader(wh: Warehouse, source: str, base: int, threads: int):
    def load(batch_df: DataFrame, epoch_id: int) -> None:
        batch = base + epoch_id
        newest = batch_df.agg(F.max(LANDED).cast("string")).first()[0]
        if newest is None:
            return
        stamp, batch_df = newest, batch_df.drop(LANDED)
        bronze = extract_bronze(conform(batch_df, source), BRONZE_COLUMNS[source], stamp)
        wh.write_full(bronze, "bronze", BRONZE[source])
        _run_all(silver_tasks(wh, [source], batch), threads)
    return load


def start_landing_load(spark: SparkSession, wh: Warehouse, landing_dir: str,
                       sources: Iterable[str], base_batch: int,
                       checkpoint_dir: str | None = None, available_now: bool = True,
                       threads: int = DEFAULT_THREADS,
                       schemas: Mapping[str, T.StructType] | None = None) -> list[StreamingQuery]:
    """Start one stream per source; ``base_batch`` must exceed every load
    partition already stored (e.g. a yyyymmddHHMM of the stream's start).
    A source of which nothing has landed yet needs its file types in ``schemas``."""
    ckpt = checkpoint_dir or f"{scratch_root(spark)}/tessera-streams"
    queries = []
    for source in sources:
        landing = f"{landing_dir.rstrip('/')}/{source}"
        schema = (schemas or {}).get(source) or spark.read.parquet(landing).schema
        stream = (spark.readStream.schema(schema).parquet(landing)
                  .select("*", F.col("_metadata.file_modification_time").alias(LANDED)))
        writer = (stream.writeStream.foreachBatch(_loader(wh, source, base_batch, threads))
                  .option("checkpointLocation", f"{ckpt}/{source}")
                  .queryName(f"land_{source}"))
        writer = writer.trigger(availableNow=True) if available_now else \
            writer.trigger(processingTime="1 minute")
        queries.append(writer.start())
    return queries


def run_landing_once(spark: SparkSession, wh: Warehouse, landing_dir: str,
                     sources: Iterable[str], base_batch: int,
                     checkpoint_dir: str | None = None) -> None:
    """Load everything landed so far and stop (``availableNow``)."""
    for q in start_landing_load(spark, wh, landing_dir, sources, base_batch, checkpoint_dir):
        q.awaitTermination()


# -- by manifest ---------------------------------------------------------------
#: A manifest is a JSON file: the extract's folder, relative to ``<landing>/<source>``, and its stamp.
MANIFEST = "path string, loaded_at string"


def _extract_loader(wh: Warehouse, source: str, folder: str, base: int, threads: int):
    def load(manifests: DataFrame, epoch_id: int) -> None:
        for m in manifests.collect():  # one file a trigger, one line a file
            if not m.path:
                raise ValueError(f"{source}: a manifest names no path")
            rows = wh.spark.read.parquet(f"{folder}/{m.path.strip('/')}")
            bronze = extract_bronze(conform(rows, source), BRONZE_COLUMNS[source],
                                    m.loaded_at or m[LANDED])
            wh.write_full(bronze, "bronze", BRONZE[source])
            _run_all(silver_tasks(wh, [source], base + epoch_id), threads)
    return load


def start_extract_load(spark: SparkSession, wh: Warehouse, landing_dir: str,
                       sources: Iterable[str], base_batch: int,
                       checkpoint_dir: str | None = None, available_now: bool = True,
                       threads: int = DEFAULT_THREADS) -> list[StreamingQuery]:
    """Start one stream per source over ``<landing>/manifests/<source>/*.json`` (the folder must
    exist); extracts lie in folders under ``<landing>/<source>/``.  Manifests are loaded in the
    order of their modification times; ``base_batch`` must exceed every stored load."""
    ckpt = checkpoint_dir or f"{scratch_root(spark)}/tessera-streams"
    queries = []
    for source in sources:
        stream = (spark.readStream.schema(MANIFEST).option("maxFilesPerTrigger", 1)
                  .option("maxFileAge", "36500d")  # a manifest that was written long ago counts, too
                  .option("multiLine", True)
                  .json(f"{landing_dir.rstrip('/')}/manifests/{source}")
                  .select("*", F.col("_metadata.file_modification_time").cast("string").alias(LANDED)))
        loader = _extract_loader(wh, source, f"{landing_dir.rstrip('/')}/{source}", base_batch, threads)
        writer = (stream.writeStream.foreachBatch(loader)
                  .option("checkpointLocation", f"{ckpt}/manifests-{source}")
                  .queryName(f"extracts_{source}"))
        writer = writer.trigger(availableNow=True) if available_now else \
            writer.trigger(processingTime="1 minute")
        queries.append(writer.start())
    return queries


def run_extracts_once(spark: SparkSession, wh: Warehouse, landing_dir: str,
                      sources: Iterable[str], base_batch: int,
                      checkpoint_dir: str | None = None) -> None:
    """Load every extract that has a manifest by now and stop (``availableNow``)."""
    for q in start_extract_load(spark, wh, landing_dir, sources, base_batch, checkpoint_dir):
        q.awaitTermination()
