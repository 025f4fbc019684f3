"""Packing by concatenation and cutting, with two-pass prefix sums.

Pass 1 encodes each document once and writes its ids with the running token
offset inside its partition.  The totals per partition (one row per partition)
are summed up to global offsets.  Pass 2 adds them, which is row-local, and cuts
each document where the fixed windows end; the pieces are the boundary records.
All sequences but the last are full.

Defined results: null text is empty; an empty document is its end id alone;
rows with equal ids are packed separately; an empty table gives no piece.
The order is that of the input's partitions and rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from loomkit.session import ship_package

from .bpe import encoder
from .common import blocks, col, text_or_empty, written

WINDOW = 1024
END_ID = 0
BLOCK = 4 << 20  # bytes of text encoded together: its distinct stretches are looked up once


def encode_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text",
                     end_id: int = END_ID) -> DataFrame:
    """Pass 1: (part, local_start, id, n, ids) with ids as little-endian 32-bit words, end id included."""
    ship_package(docs.sparkSession)

    def run(batches):
        part, at = TaskContext.get().partitionId(), 0
        enc = encoder(tokenizer)
        for whole in batches:
            for lo, hi in blocks(np.array(pc.binary_length(whole.column(1)), np.int64), BLOCK):
                b = whole.slice(lo, hi - lo)
                ids, n = enc.encode_many(b.column(1), end_id)
                starts = at + np.cumsum(n) - n
                at += int(n.sum())
                offsets = np.concatenate([[0], np.cumsum(n) * 4]).astype(np.int64)
                data = pa.Array.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(offsets), pa.py_buffer(ids.astype("<u4"))])
                yield pa.record_batch([pa.array(np.full(len(n), part, np.int64)), pa.array(starts), b.column(0), pa.array(n), data.cast(pa.binary())],
                                      names=["part", "local_start", "id", "n", "ids"])

    rows = docs.select(col(id_col).alias("id"), text_or_empty(text).alias("text"))
    schema = T.StructType([T.StructField("part", T.LongType()), T.StructField("local_start", T.LongType()),
                           T.StructField("id", rows.schema["id"].dataType), T.StructField("n", T.LongType()),
                           T.StructField("ids", T.BinaryType())])
    return rows.mapInArrow(run, schema)


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text", window: int = WINDOW,
         end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """Pieces: id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ``ids``, the piece's words)."""
    coded = written(encode_documents(docs, tokenizer, id_col, text, end_id), "packing-ids")
    totals = coded.groupBy("part").agg(F.sum("n").alias("tokens"))  # one row per partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("part", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))
    placed = coded.join(F.broadcast(base), "part")  # bounded by the number of partitions
    rows = placed.select("id", (F.col("base") + F.col("local_start")).alias("at"), "n", "ids")

    def cut(batches):
        for b in batches:
            pieces = []
            for i, (at, n) in enumerate(zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)):
                words, lo = memoryview(b.column(3)[i].as_buffer()), 0
                while lo < n:
                    hi = min(n, lo + window - (at + lo) % window)
                    part = words[4 * lo:4 * hi]
                    pieces.append((i, lo, hi - lo, zlib.crc32(part), n, (at + lo) // window, (at + lo) % window,
                                   bytes(part) if with_ids else b""))
                    lo = hi
            if not pieces:
                continue
            k, *rest = zip(*pieces, strict=True)
            cols = [b.column(0).take(pa.array(k))] + [pa.array(x, pa.int64()) for x in rest[:-1]]
            names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                cols, names = [*cols, pa.array(rest[-1], pa.binary())], [*names, "ids"]
            yield pa.record_batch(cols, names=names)

    longs = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), *[T.StructField(x, T.LongType()) for x in longs],
                           *([T.StructField("ids", T.BinaryType())] if with_ids else [])])
    return rows.mapInArrow(cut, schema).withColumnRenamed("id", id_col)


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids): the pieces of each sequence put together again (at most one window of ids a row)."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    whole = F.aggregate(parts, F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"]))
    return pieces.groupBy("sequence_id").agg(whole.alias("ids"))
