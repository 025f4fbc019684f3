"""Filter interaction audit: five filters, every order, by incremental retraction streaming.

A structured stream reads the files of a folder in available-now micro-batches.
Filters A to D depend on a text alone and are a bit mask per row.  E (an equal text
has a smaller id anywhere in the table) depends on what comes later, so it is kept
as state: per text key (SHA-256) the smallest id seen so far and, by part and
label, the rows that have it.  A micro-batch folds its rows to one per key, part
and label inside each task, meets the state on the key, and adds to the part
counters: rows above the smallest id count under ``mask | E``.  When a smaller id arrives, the rows that
held the key before are retracted from ``mask`` and counted under ``mask | E``.

State and counter changes of batch n are written to the shared folder under the
batch's number and read from the number before, so a batch that is repeated
after a failure overwrites its own output, and a later run of the same stream
folder goes on with the files that have arrived since.  The counters are a
row per batch, part, mask and label; all 120 orders follow from them, without the documents.

Filters (failure): A under 200 words, B 100 * distinct words < 50 * words, C 100 * ``[A-Z]``
characters > 3 * code points, D holds any of ``#$%&*|``, E an equal text has a smaller id.

Defined results: null text is the empty text, which fails A alone, and E if repeated; null part is the empty
string; rows with equal ids and texts are rows of their own and do not fail E by each
other; a null id is neither smaller nor larger than any, so such rows never fail E or make another
fail, and have no label; several labels of an id count as 1 if any is 1.  An empty table gives an empty result;
columns other than the named ones are not read.
"""

from __future__ import annotations

import math
import os
import uuid
from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomkit.session import scratch_path

from .common import col, text_or_empty

FILTERS = "ABCDE"
BIT = {f: 1 << i for i, f in enumerate(FILTERS)}
MICRO_BATCHES = 4
CLASS = ["part", "mask", "good", "toxic"]
_SPACE = r"[\x20\x09-\x0D]+"


def mask_of(text: Column) -> Column:
    """Bits of the filters A to D that a non-null text fails."""
    bit = lambda f, fails: F.when(fails, BIT[f]).otherwise(0)
    long = lambda x: x.cast("long")
    words = F.array(F.array_remove(F.split(text, _SPACE), ""))  # the words are split once
    of_words = F.transform(words, lambda w: bit("A", F.size(w) < 200) + bit("B", long(F.size(F.array_distinct(w))) * 100 < long(F.size(w)) * 50))[0]
    capitals = long(F.length(F.regexp_replace(text, "[^A-Z]+", "")))
    return of_words + bit("C", capitals * 100 > long(F.length(text)) * 3) + bit("D", text.rlike("[#$%&*|]"))


def reduced(docs: DataFrame, id_col: str, text: str, part: str) -> DataFrame:
    """(id, key, part, mask) of every row."""
    t = text_or_empty(text)
    return docs.select(col(id_col).cast("long").alias("id"), F.unhex(F.sha2(t, 256)).alias("key"),
                       F.coalesce(col(part).cast("string"), F.lit("")).alias("part"), mask_of(t).alias("mask"))


def label_flags(labels: DataFrame, id_col: str) -> DataFrame:
    """(id, good, toxic): one row per labelled id."""
    one = lambda c: F.max(F.coalesce(col(c) == 1, F.lit(False)).cast("int"))
    return labels.where(col(id_col).isNotNull()).groupBy(col(id_col).cast("long").alias("id")).agg(
        one("quality").alias("good"), one("toxic").alias("toxic"))


class Retraction:
    """State and counters of one stream, in versions of the shared folder ``path``."""

    def __init__(self, spark: SparkSession, path: str, labels: DataFrame, label_id: str = "doc_id"):
        self.spark, self.path, self.labels = spark, path, label_flags(labels, label_id)

    def at(self, kind: str, n: int) -> str:
        return os.path.join(self.path, kind, f"batch={n}")

    def _write(self, df: DataFrame, kind: str, n: int) -> DataFrame:
        df.write.mode("overwrite").option("compression", "zstd").parquet(self.at(kind, n))
        return self.spark.read.schema(df.schema).parquet(self.at(kind, n))

    def _file_system(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _delete(self, kind: str, n: int) -> None:
        p, fs = self._file_system(self.at(kind, n))
        fs.delete(p, True)

    def _exists(self, path: str) -> bool:
        p, fs = self._file_system(path)
        return fs.exists(p)

    def state(self, n: int) -> DataFrame:
        """(key, part, mask, good, toxic, id, n): the rows that hold the smallest id of each key after batch ``n``."""
        if n < 0:
            return self.spark.createDataFrame([], "key binary, part string, mask int, good int, toxic int, id long, n long")
        met = self.spark.read.parquet(self.at("met", n)).where("id = least")
        return met.groupBy("key", *CLASS).agg(F.first("id").alias("id"), F.sum("n").alias("n"))

    def step(self, rows: DataFrame, n: int) -> None:
        """Fold the reduced rows of micro-batch ``n`` into state and counters."""
        rows = self._write(rows, "rows", n)  # read with the caller's session: adaptive plans are off inside a stream
        same = rows.where("id is not null").groupBy("key", "part", "mask", "id").agg(F.count(F.lit(1)).alias("n"))
        flag = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
        known = same.join(self.labels, "id", "left").select("key", "part", "mask", "id", "n", flag("good"), flag("toxic"))
        low = F.min(F.struct("id", "n")).alias("low")  # ids are distinct within a key, part and label
        new = known.groupBy("key", *CLASS).agg(low, F.sum("n").alias("total")).select(
            "key", *CLASS, "low.id", "low.n", "total", F.lit(True).alias("new"))
        old = self.state(n - 1).select("key", *CLASS, "id", "n", F.col("n").alias("total"), F.lit(False).alias("new"))
        met = new.unionByName(old).withColumn("least", F.min("id").over(Window.partitionBy("key")))  # a few rows a key
        met = self._write(met, "met", n)
        first = F.col("id") == F.col("least")
        kept = F.when(F.col("new") & first, F.col("n")).when(~F.col("new") & ~first, -F.col("n")).otherwise(F.lit(0))
        gone = F.when(F.col("new"), F.col("total") - kept).otherwise(-kept)
        change = F.explode(F.array(F.struct(F.col("mask"), kept.alias("n")), F.struct((F.col("mask") + BIT["E"]).alias("mask"), gone.alias("n"))))
        counted = met.select("part", "good", "toxic", change.alias("c")).where("c.n <> 0").select("part", "c.mask", "good", "toxic", "c.n")
        loose = rows.where("id is null").groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n")).select(
            "part", "mask", F.lit(0).alias("good"), F.lit(0).alias("toxic"), "n")
        self._write(counted.unionByName(loose).groupBy(*CLASS).agg(F.sum("n").alias("n")), "counters", n)
        self._delete("rows", n)
        if n > 1:
            self._delete("met", n - 2)  # n - 1 stays until n has been committed

    def counters(self) -> DataFrame:
        """(part, mask, good, toxic, n) over all batches."""
        schema, at = "part string, mask int, good int, toxic int, n long", os.path.join(self.path, "counters")
        per = self.spark.read.schema(schema).parquet(at) if self._exists(at) else self.spark.createDataFrame([], schema)
        return per.groupBy(*CLASS).agg(F.sum("n").alias("n")).where("n <> 0")


def run_stream(spark: SparkSession, docs_path: str, labels: DataFrame, path: str, id_col: str = "doc_id", text: str = "text",
               part: str = "lang", micro_batches: int = MICRO_BATCHES) -> Retraction:
    """Process all files of ``docs_path`` not yet seen by the stream kept under ``path``."""
    source = spark.read.parquet(docs_path)
    files = math.ceil(max(1, len(source.inputFiles())) / micro_batches)
    kept = Retraction(spark, path, labels)
    at, fs = kept._file_system(docs_path)
    if fs.getFileStatus(at).isFile():  # a stream takes folders and patterns
        docs_path = f"{docs_path[:-1]}[{docs_path[-1]}]"
    stream = spark.readStream.schema(source.schema).option("maxFilesPerTrigger", files).option("maxFileAge", "36500d").parquet(docs_path)
    query = (reduced(stream, id_col, text, part).writeStream.foreachBatch(lambda rows, n: kept.step(rows, n))
             .option("checkpointLocation", os.path.join(path, "stream")).trigger(availableNow=True).start())
    query.awaitTermination()
    return kept


def report(counters: DataFrame) -> DataFrame:
    """Per part, filter_order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    cell = lambda what, m: F.coalesce(F.sum(F.when((F.col("mask") == m) & what, F.col("n"))), F.lit(0))
    sums = {"n": F.lit(True), "g": F.col("good") == 1, "t": F.col("toxic") == 1}
    wide = counters.groupBy("part").agg(*[F.array(*[cell(w, m) for m in range(32)]).alias(c) for c, w in sums.items()])
    steps = [(("".join(o)), i + 1, sum(BIT[f] for f in o[:i]), BIT[o[i]]) for o in permutations(FILTERS) for i in range(5)]
    orders = F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(i).alias("step"), F.lit(p).alias("before"), F.lit(b).alias("bit"))
                       for o, i, p, b in steps])
    each = wide.select("part", *sums, F.explode(orders).alias("s")).select("part", *sums, "s.*")

    def over(column: str, keep: str, weight: str = "1") -> Column:
        return F.expr(f"aggregate(transform({column}, (x, m) -> if({keep}, x * {weight}, 0L)), 0L, (a, x) -> a + x)")

    here = "m & before = 0 and m & bit <> 0"
    return each.select(
        "part", "filter_order", "step", over("n", "m & (before | bit) = 0").alias("kept"), over("n", here).alias("removed"),
        over("n", "m & bit <> 0 and m & before <> 0").alias("redundant"), F.expr("element_at(n, bit + 1)").alias("unique_fails"),
        over("g", here).alias("good_lost"), over("t", here).alias("toxic_lost"),
        over("n", "m & bit <> 0", "(120 div greatest(bit_count(m), 1))").alias("shapley"))  # its filter comes first among those that fail


def audit(spark: SparkSession, docs_path: str, labels: DataFrame, id_col: str = "doc_id", text: str = "text", part: str = "lang",
          micro_batches: int = MICRO_BATCHES) -> DataFrame:
    """The whole report over all files of ``docs_path``, in a stream folder of its own."""
    path = scratch_path(spark, f"llm/audit-{uuid.uuid4().hex}")
    return report(run_stream(spark, docs_path, labels, path, id_col, text, part, micro_batches).counters())
