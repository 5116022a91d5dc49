"""Layered store on catalog tables: a database a layer, a table a model.

``<prefix><layer>.<table>`` are managed parquet tables under ``<root>/<layer>``, so that models are read
by name, from Spark SQL as well.  Writing, committing, replacing and deleting are Spark's:

* full-refresh tables (bronze, gold) are built under another name and take the table's name when
  they are complete, so a failed rebuild leaves the previous table as it was;
* incremental tables (silver) are partitioned by load and bucketed by their hub key.  A load
  overwrites its own partition alone (dynamic partition overwrite) and compares itself with the
  partitions before it, so that a repeated load reproduces its rows instead of appending them
  twice.  Buckets are what saves shuffles of stored rows: joins and windows on the hub key read
  history where it lies;
* a full refresh of an incremental table is built under another name as well;
* loads go forward: a load older than the newest stored one is refused.

What is stored is what the catalog lists; files of an interrupted write are in no table.  Another
application sees the tables if the session's catalog is persistent (a metastore).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_COL = "_batch"
NEXT = "__next"
#: Hash keys are most of what is stored: hex digits, half a byte each to a codec with entropy coding.
CODEC = "zstd"


def layer_name(custom: str | None, default: str) -> str:
    """Namespace routing: a custom layer name is used as is (trimmed),
    otherwise the default one."""
    return default if custom is None else custom.strip()


class Warehouse:
    """``prefix``: of the database names.  "" gives ``bronze``, ``silver`` and ``gold``; None a prefix of
    the root's own, so that warehouses of one session do not meet.  ``buckets``: files a load and
    silver table (default: the session's shuffle partitions), for all loads the same."""

    def __init__(self, spark: SparkSession, root: str, layers: dict[str, str | None] | None = None,
                 default_layer: str = "main", prefix: str | None = None, buckets: int | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.layers = layers or {}
        self.default_layer = default_layer
        self.prefix = f"wh_{hashlib.md5(self.root.encode()).hexdigest()[:12]}_" if prefix is None else prefix
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self._databases: set[str] = set()

    # -- naming -------------------------------------------------------------
    def database(self, layer: str) -> str:
        routed = layer_name(self.layers.get(layer, layer), self.default_layer)
        name, place = f"{self.prefix}{routed}", f"{self.root}/{routed}"
        if name not in self._databases:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{place}'")
            there = self.spark.catalog.getDatabase(name).locationUri
            if there.removeprefix("file:").rstrip("/") != place.removeprefix("file:"):
                raise ValueError(f"database {name} lies in {there}, not in {place}; give a prefix")
            self._databases.add(name)
        return name

    def table(self, layer: str, name: str) -> str:
        """The table's name in the catalog."""
        return f"`{self.database(layer)}`.`{name}`"

    def exists(self, layer: str, name: str) -> bool:
        """Whether a full table, or any load of an incremental one, is stored."""
        table = self.table(layer, name)
        if not self.spark.catalog.tableExists(table):
            return False
        return not self._by_load(table) or bool(self._loads(table))

    def drop(self) -> None:
        """Remove the warehouse's databases and their files."""
        for name in sorted(self._databases):
            self.spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")
        self._databases.clear()

    def _by_load(self, table: str) -> bool:
        return BATCH_COL in self.spark.table(table).columns

    def _loads(self, table: str) -> list[int]:
        return sorted(int(r[0].removeprefix(f"{BATCH_COL}="))
                      for r in self.spark.sql(f"SHOW PARTITIONS {table}").collect())

    # -- full refresh --------------------------------------------------------
    def _replace(self, layer: str, name: str) -> None:
        """The table that was built beside takes the name."""
        table = self.table(layer, name)
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self.spark.sql(f"ALTER TABLE {self.table(layer, name + NEXT)} RENAME TO {table}")

    def write_full(self, df: DataFrame, layer: str, name: str, *more: DataFrame) -> None:
        """Replace a table by the rows of ``df`` and of ``more``, written one after the other."""
        beside = self.table(layer, name + NEXT)
        self.spark.sql(f"DROP TABLE IF EXISTS {beside}")
        for part in (df, *more):
            part.write.format("parquet").option("compression", CODEC).mode("append").saveAsTable(beside)
        self._replace(layer, name)

    # -- incremental ---------------------------------------------------------
    def _create(self, df: DataFrame, table: str, key: str | None) -> None:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        dealt = f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {self.buckets} BUCKETS" if key else ""
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}, {BATCH_COL} BIGINT) USING parquet "
                       f"OPTIONS (partitionOverwriteMode 'dynamic', compression '{CODEC}') PARTITIONED BY ({BATCH_COL}) {dealt}")

    def write_batch(self, df: DataFrame, layer: str, name: str, batch: int, full_refresh: bool = False,
                    key: str | None = None, dealt: bool = False) -> None:
        """Write one load; with ``full_refresh`` it replaces all that is stored.  ``key``: the column
        that a new table is bucketed by; ``dealt`` says that the rows come from a join with the
        stored table on that column, so that each task holds one bucket already."""
        stored = self.batch_ids(layer, name)
        if stored and stored[-1] > batch:
            raise ValueError(f"{layer}.{name}: load {batch} is older than stored load "
                             f"{stored[-1]}; replay loads in order")
        target = name + NEXT if full_refresh else name
        table = self.table(layer, target)
        if full_refresh:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self._create(df, table, key)
        if batch in stored and not full_refresh:
            self.drop_batch(layer, name, batch)  # also if the load is empty now
        if key and not dealt:
            df = df.repartition(self.buckets, key)
        df.withColumn(BATCH_COL, F.lit(batch).cast("bigint")).write.insertInto(table, overwrite=True)
        # a load without rows is a load, too
        self.spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({BATCH_COL}={batch})")
        if full_refresh:
            self._replace(layer, name)

    def drop_table(self, layer: str, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table(layer, name)}")

    def drop_batch(self, layer: str, name: str, batch: int) -> None:
        self.spark.sql(f"ALTER TABLE {self.table(layer, name)} DROP IF EXISTS PARTITION ({BATCH_COL}={batch})")

    # -- reads ---------------------------------------------------------------
    def read(self, layer: str, name: str) -> DataFrame:
        return self.spark.table(self.table(layer, name)).drop(BATCH_COL)

    def read_before(self, layer: str, name: str, batch: int,
                    after: int | None = None) -> DataFrame | None:
        """Stored state as seen by load ``batch`` (with ``after``, only the loads after that
        one); None where there is none."""
        loads = [b for b in self.batch_ids(layer, name)
                 if b < batch and (after is None or b > after)]
        return self._only(layer, name, F.col(BATCH_COL).isin(loads)) if loads else None

    def read_batch(self, layer: str, name: str, batch: int) -> DataFrame:
        """Rows appended by load ``batch``."""
        return self._only(layer, name, F.col(BATCH_COL) == batch)

    def _only(self, layer: str, name: str, loads) -> DataFrame:
        return self.spark.table(self.table(layer, name)).filter(loads).drop(BATCH_COL)

    def batch_ids(self, layer: str, name: str) -> list[int]:
        """Stored loads, ascending."""
        table = self.table(layer, name)
        return self._loads(table) if self.spark.catalog.tableExists(table) else []

    def max_batch(self, layer: str, name: str, before: int) -> int | None:
        """Newest load below ``before``, or None."""
        earlier = [b for b in self.batch_ids(layer, name) if b < before]
        return max(earlier) if earlier else None

    def dealt_by(self, layer: str, name: str) -> str | None:
        """The column that a stored table is bucketed by."""
        columns = self.spark.catalog.listColumns(self.table(layer, name))
        return next((c.name for c in columns if c.isBucket), None)

    def sizes(self) -> dict[tuple[str, str], int]:
        """Bytes of each stored table's files, by database (without prefix) and name, when none is being
        written.  (ANALYZE TABLE would have small tables broadcast by the size of their files.)"""
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(self.root)
        place = [F.regexp_extract("path", r"([^/]+)/([^/]+)/(_batch=[^/]+/)?[^/]+$", i) for i in (1, 2)]
        return {(r[0], r[1]): r[2] for r in files.groupBy(*place).agg(F.sum("length")).collect()}

    def batches(self, layer: str, name: str) -> DataFrame:
        """Row count per load (a metadata-sized aggregate)."""
        return (self.spark.table(self.table(layer, name)).groupBy(BATCH_COL)
                .agg(F.count(F.lit(1)).alias("rows_added")))
