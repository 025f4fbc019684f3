"""Small files and folders on whatever storage the cluster shares."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def arrow_fs(path: str):
    """A pyarrow file system and the path in it (local, s3, gs, hdfs ...); also works in Python workers."""
    import pyarrow.fs as pafs
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if "://" not in path:
        return pafs.LocalFileSystem(), os.path.abspath(path)
    return pafs.FileSystem.from_uri(path)


def read_text(path: str) -> str:
    fs, at = arrow_fs(path)
    with fs.open_input_stream(at, compression=None) as f:
        return f.read().decode()


def write_text(path: str, text: str) -> None:
    fs, at = arrow_fs(path)
    fs.create_dir(os.path.dirname(at), recursive=True)
    with fs.open_output_stream(at, compression=None) as f:
        f.write(text.encode())


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
