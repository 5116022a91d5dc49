"""Named raw-source scans.  Values and types pass through as the source declares them: casts belong
to the satellites."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.schemas import SOURCE_SCHEMAS

#: formats whose files carry no types; they are read with the declared ones
TEXT_FORMATS = ("csv", "json")


def conform(df: DataFrame, name: str) -> DataFrame:
    """Project a raw frame onto the declared columns of source ``name``:
    extra columns are dropped, missing ones raise, types stay."""
    columns = SOURCE_SCHEMAS[name].fieldNames()
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"source {name!r} lacks columns {missing}")
    return df.select(*columns)


def read_source(spark: SparkSession, name: str, base: str, fmt: str = "parquet",
                **options: str) -> DataFrame:
    """Scan raw table ``name`` under ``base`` (``<base>/<name>``) as parquet,
    csv, json or orc, or through JDBC (``base`` = URL, ``dbtable`` = name).

    Text files fail on a value that does not fit its declared type, and on a
    csv header other than the declared columns, instead of yielding NULLs."""
    if fmt == "jdbc":
        df = (spark.read.format("jdbc").option("url", base)
              .option("dbtable", options.pop("dbtable", f"public.{name}"))
              .options(**options).load())
        return conform(df, name)
    reader = spark.read
    if fmt in TEXT_FORMATS:
        reader = reader.schema(SOURCE_SCHEMAS[name]).option("mode", "FAILFAST")
    if fmt == "csv":
        reader = reader.option("header", "true").option("enforceSchema", "false")
    return conform(reader.options(**options).format(fmt).load(f"{base.rstrip('/')}/{name}"), name)
