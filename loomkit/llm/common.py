"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomkit.session import scratch_path


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def col(name: str) -> Column:
    """A column by its literal name (dots and backticks included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct, so that helper columns never clash with the caller's names."""
    return F.struct(*[col(c) for c in df.columns])


def unpack_row(df: DataFrame, row: str, names: list[str]) -> DataFrame:
    """The struct column ``row`` spread out again under the caller's column names."""
    return df.select(*[F.col(row).getField(n).alias(n) for n in names])


def text_or_empty(name: str) -> Column:
    return F.coalesce(col(name).cast("string"), F.lit(""))


def written(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage with files every executor sees, so a lost executor costs
    a re-read and nothing upstream runs twice."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm/{name}-{uuid.uuid4().hex}")
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_written(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete tables made by ``written`` that nothing reads any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for t in tables:
        folders = {f.rsplit("/", 1)[0] for f in t.inputFiles()}
        for d in folders:
            p = jvm.org.apache.hadoop.fs.Path(d)
            p.getFileSystem(conf).delete(p, True)


def bytes_of(arr: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, offsets) of a string or binary Arrow array without nulls."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    arr = arr.cast(pa.large_binary())
    _, off, data = arr.buffers()
    offsets = np.frombuffer(off, np.int64, len(arr) + 1, arr.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]] if len(arr) else raw[:0], offsets - offsets[0]


def blocks(lengths: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges whose lengths add up to ``limit`` at most (one row at least), to bound temporaries."""
    lo, total = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if i > lo and total + n > limit:
            yield lo, i
            lo, total = i, 0
        total += n
    if lo < len(lengths):
        yield lo, len(lengths)
