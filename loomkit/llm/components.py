"""Connected components by alternating large-star and small-star steps over written edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_written, written


def _mark(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return r["n"], r["x"]


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): the smallest node reachable, for every node that has an edge (a, b); one row a node.

    Each step links nodes to the smallest of their neighbourhood; a hub's rows
    only meet in sums that are combined before the shuffle and in joins whose
    skew adaptive execution splits.  Only two numbers a step reach the driver."""
    spark = edges.sparkSession
    e = written(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc")
    before = None
    while (now := _mark(e)) != before:
        before = now
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = written(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), "cc-low")
        large = written(both.where("b > a").join(low.hint("merge"), "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "cc")
        low2 = written(large.groupBy("a").agg(F.min("b").alias("m")), "cc-low")
        small = large.join(low2.hint("merge"), "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        nxt = written(small.unionByName(low2.select("a", F.col("m").alias("b"))).distinct(), "cc")
        drop_written(spark, e, low, large, low2)
        e = nxt
    return e.select(F.col("a").alias("node"), F.col("b").alias("comp")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct())
