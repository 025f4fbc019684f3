"""Exact deduplication by distributed most-significant-digit radix partitioning.

Normalised texts (every character of ``[\\x20\\x09-\\x0D]`` deleted, null as
empty) are split by successive bytes.  The first digit is the length with the
first ``FIRST`` bytes; each further digit is the next stretch of bytes, ``GROWTH``
times longer than the one before.  After each digit, groups of one row are
finished, groups whose text has ended are equal texts, and only the rest go on.
Every comparison is Spark's comparison of the bytes themselves: no digest
decides equality.

Defined results: null text is empty text, and empty texts form one group; rows
with equal ids are separate rows (the one that stays is fixed by text length,
then smallest id, nulls last, then row number); an empty table gives an empty
result; other columns are carried along untouched.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, drop_written, text_or_empty, unpack_row, whole_row, written

FIRST, GROWTH, LARGEST = 64, 32, 1 << 24


def normalised(text: Column) -> Column:
    return F.translate(text, " \t\n\x0b\x0c\r", "")


def _split(rows: DataFrame, keys: list[str], out: list) -> DataFrame:
    """``rows`` that share ``keys`` with another row, with the group's number ``gid`` (its smallest row).

    The groups are written first, so both sides of the join are plain shuffles
    and a hot group's rows can be split among tasks."""
    groups = rows.groupBy(*keys).agg(F.min("rid").alias("new"), F.count(F.lit(1)).alias("n")).where("n > 1")
    groups = written(groups.select(*keys, "new"), "radix-groups")
    return rows.join(groups.hint("merge"), keys).select(F.col("new").alias("gid"), *out)


def _base(docs: DataFrame, text: str) -> DataFrame:
    norm = normalised(text_or_empty(text))
    d = docs.select(whole_row(docs).alias("row"), F.monotonically_increasing_id().alias("rid"),
                    F.char_length(text_or_empty(text)).alias("n_chars"), norm.alias("norm"))
    return written(d.select("row", "rid", "n_chars", F.octet_length("norm").alias("len"), F.sha2("norm", 256).alias("sha"),
                            F.substring(F.col("norm").cast("binary"), 1, FIRST).alias("digit")), "radix-rows")


def _classes(base: DataFrame, text: str) -> tuple[DataFrame, list[DataFrame]]:
    """(rid, gid) of every row whose text another row has too; the written tables behind it."""
    spark = base.sparkSession
    first = written(_split(base.select("rid", "len", "digit"), ["len", "digit"], ["rid", "len"]), "radix-0")
    done, tables, at, width = [first.where(F.col("len") <= FIRST).select("rid", "gid")], [first], FIRST, FIRST
    norm = normalised(F.coalesce(F.col("row").getField(text).cast("string"), F.lit("")))
    rest = F.substring(norm.cast("binary"), FIRST + 1, 2147483647)
    more = first.where(F.col("len") > FIRST).hint("merge")  # grows with the corpus: never broadcast
    live = written(base.select("rid", rest.alias("rest")).join(more, "rid").select("rid", "gid", "len", "rest"), "radix-live")
    while not live.isEmpty():
        width = min(width * GROWTH, LARGEST)
        at += width
        rows = live.select("rid", "gid", "len", F.substring("rest", 1, width).alias("digit"),
                           F.substring("rest", width + 1, 2147483647).alias("rest"))
        step = written(_split(rows, ["gid", "digit"], ["rid", "len", "rest"]), "radix-live")
        drop_written(spark, live)
        tables.append(step)
        done.append(step.where(F.col("len") <= at).select("rid", "gid"))
        live = step.where(F.col("len") > at)
        if not live.isEmpty():
            live = written(live, "radix-live")
    return reduce(DataFrame.unionByName, done), tables


def _flags(docs: DataFrame, id_col: str, text: str) -> tuple[DataFrame, DataFrame]:
    base = _base(docs, text)
    narrow = base.select("rid", F.col("row").getField(id_col).alias("id"), "n_chars", "sha")
    classes, _ = _classes(base, text)
    members = classes.join(narrow.select("rid", "id", "n_chars"), "rid")
    best = F.min(F.struct(-F.col("n_chars"), F.isnull("id"), F.col("id"), F.col("rid")))
    per = members.groupBy("gid").agg(F.count(F.lit(1)).alias("n"), best.alias("b"))
    per = written(per.select("gid", "n", F.col("b.id").alias("keep"), F.col("b.rid").alias("keep_rid")), "radix-classes")
    found = classes.join(per.hint("merge"), "gid").select("rid", "n", "keep", "keep_rid")
    return base, narrow.join(found, "rid", "left").select(
        "rid", "id", F.when(F.isnull("n"), F.col("id")).otherwise(F.col("keep")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("rid") == F.col("keep_rid"), F.lit(True)).alias("kept"), "sha")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: its id, ``keep_id``, ``group_size``, ``kept`` and the normalised text's SHA-256."""
    _, flags = _flags(docs, id_col, text)
    return flags.select(F.col("id").alias(id_col), "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256"))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns as they were."""
    base, flags = _flags(docs, id_col, text)
    kept = base.select("rid", "row").join(flags.where(~F.col("kept")).select("rid"), "rid", "left_anti")
    return unpack_row(kept, "row", docs.columns)
