"""File tables: read by suffix (S1), write in a chosen format (S11), and a
stable seeded sample of rows (S12)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..functions.hashing import seeded_md5

# File suffix -> format.
SUFFIX_FORMATS = {".csv": "csv", ".parquet": "parquet", ".pq": "parquet"}
WRITE_FORMATS = ("parquet", "csv", "json")


def detect_format(path: str) -> str:
    """Format from the lower-cased suffix; unknown suffix is an error."""
    p = path.rstrip("/")
    suffix = os.path.splitext(p)[1].lower()
    if suffix in SUFFIX_FORMATS:
        return SUFFIX_FORMATS[suffix]
    raise ValueError(f"Unknown file format: {suffix}\nSupported: .csv, .parquet, .pq\n"
                     f"Or specify file_format explicitly.")


def read_table(spark: SparkSession, path: str, fmt: str | None = None,
               schema: StructType | None = None, **options) -> DataFrame:
    """Parquet as is; CSV with a header and an inferred (or given) schema."""
    fmt = (fmt or detect_format(path)).lower()
    if fmt == "parquet":
        return spark.read.options(**options).parquet(path)
    if fmt == "csv":
        r = spark.read.option("header", "true").options(**options)
        r = r.schema(schema) if schema is not None else r.option("inferSchema", "true")
        return r.csv(path)
    if fmt in ("json", "orc"):
        r = spark.read.options(**options)
        if schema is not None:
            r = r.schema(schema)
        return r.format(fmt).load(path)
    raise ValueError(f"Unsupported format: {fmt}")


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by=None, **options) -> str:
    """Write in ``parquet``, ``csv`` (with header) or ``json``."""
    fmt = fmt.lower()
    if fmt not in WRITE_FORMATS:
        raise ValueError(f"Unsupported output format: {fmt}. Supported: {', '.join(WRITE_FORMATS)}")
    w = df.write.mode(mode).options(**options)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = w.option("header", "true")
    w.format(fmt).save(path)
    return path


def sample_rows(df: DataFrame, n: int = 5, keys=None, seed: int = 42, where=None) -> DataFrame:
    """The first ``n`` rows in seeded hash order: the same rows on any
    partitioning, unlike ``head``.  (A top-k: planned as TakeOrderedAndProject.)"""
    keys = list(keys or df.columns)
    d = df.where(where) if where is not None else df
    h = seeded_md5(seed, *keys)
    return d.withColumn("_h", h).orderBy("_h", *keys).limit(n).drop("_h")
