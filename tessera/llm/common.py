"""Helpers that several operators share: the shared folder, written tables, sizes."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that separate words: space, and \t \n \v \f \r.  ``bytes.split()`` splits on the same.
SPACES = "\\x20\\x09-\\x0D"


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share, as the cluster names it in ``spark.checkpoint.dir``.

    A local-mode session that names none gets a private folder; elsewhere that is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="llm-shared-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the table read back: lineage ends here, and a
    lost executor costs a re-read, not a re-computation."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Intermediate tables of one operator, in a catalog database whose location is the shared
    folder.  Spark's own ``DROP TABLE`` removes their files once a later table holds the result."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.tables = spark, []
        self.database = f"llm_{name}_{uuid.uuid4().hex}"
        spark.sql(f"CREATE DATABASE {self.database} LOCATION '{new_path(spark, name)}'")

    def write(self, df: DataFrame, name: str, by: str | None = None) -> DataFrame:
        """``df`` as a written table, in folders by the column ``by``, read back: lineage ends
        here, and a lost executor costs a re-read."""
        table = f"{self.database}.{name}"
        writer = df.write.format("parquet")
        (writer.partitionBy(by) if by else writer).saveAsTable(table)
        self.tables.append(name)
        return self.spark.table(table)

    def keep(self, *names: str) -> None:
        """Drop all tables but these."""
        for name in [t for t in self.tables if t not in names]:
            self.spark.sql(f"DROP TABLE {self.database}.{name}")
        self.tables = list(names)


def ship(spark: SparkSession) -> None:
    """Let the executors import this package: Spark sends them a zip of it, once a session."""
    import tessera

    sc = spark.sparkContext
    if getattr(sc, "_tessera_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(tessera.__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="tessera-code-"), "tessera_code.zip")
    with zipfile.ZipFile(target, "w") as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.join("tessera", os.path.relpath(full, root)))
    sc.addPyFile(target)
    sc._tessera_shipped = True


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, nothing else (``lower`` also changes other scripts)."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACES}]+")), F.lit(0))
