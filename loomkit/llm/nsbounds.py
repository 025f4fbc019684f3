"""Centroid clustering with ns-bounds: exact Lloyd rounds that skip most distances.

A vector keeps, for every centroid, the exact squared distance of its last
evaluation and the round of it.  The driver keeps the history of all centroids
(rounds x k x dims integers).  In a later round the distance to centroid j can
have changed by the norm of j's total displacement since that evaluation at most,
which is never more than the sum of its drifts round by round.  So
``distance - displacement`` is a lower bound and, for the own centroid,
``distance + displacement`` an upper one.  A vector whose upper bound lies below all
its other lower bounds keeps its centroid unseen; else the own distance is
evaluated, and every centroid whose bound still fails is rescanned exactly.  Bounds
are loosened by a rounding margin and ties are always rescanned, so the result
is that of plain rounds, to the last integer.

Vectors are integers (``floor(scale * x)``) of at most ``LARGEST`` in size; squared distances are
exact in doubles then.  Each round is one narrow pass that writes vectors and bounds to the
shared folder, and one aggregate of k rows; no vector is shuffled.

Defined results: a vector takes part if it has exactly ``dims`` components, none null
or non-finite; others give no row.  Rows with equal ids are vectors of their own; a
null id counts as the text ``null`` in the hash; equal hashes start in the order of
their vectors.  With fewer than ``k`` vectors there are as many centroids; an empty
table gives an empty result.  A component beyond ``LARGEST`` is an error, as distances would no longer be exact.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomkit.session import ship_package

from .common import col, drop_written, written

LARGEST = 1 << 22
MARGIN = 1e-9


def quantised(df: DataFrame, id_col: str, vector: str, dims: int, scale: int) -> DataFrame:
    """(id, v): the vectors that take part, as integers."""
    x = col(vector)
    usable = (F.size(x) == dims) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = F.transform(x, lambda c: F.when(F.abs(c) * scale <= LARGEST, F.floor(c.cast("double") * scale).cast("int"))
                        .otherwise(F.raise_error(F.lit(f"components beyond {LARGEST} / scale are out of range")).cast("int")))
    return df.where(usable).select(col(id_col).alias("id"), whole.alias("v"))


def starts(points: DataFrame, k: int, seed: str) -> np.ndarray:
    """The ``k`` vectors with the smallest hash of ``<seed>:<id>``."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("null"))), 256)
    rows = points.select(h.alias("h"), "v").orderBy("h", "v").limit(k).collect()  # k rows
    return np.array([r.v for r in rows], np.int64)


def squared(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``v`` to all of ``c``; every term is an integer below 2**53."""
    v, c = v.astype(np.float64), c.astype(np.float64)
    return ((v * v).sum(1)[:, None] + (c * c).sum(1) - 2 * (v @ c.T)).astype(np.int64)


def reassign(v: np.ndarray, own: np.ndarray, dist: np.ndarray, seen: np.ndarray, history: np.ndarray) -> np.ndarray:
    """New own centroid of each vector; ``dist`` and ``seen`` (round of evaluation) are updated in place."""
    now = len(history) - 1
    k, rows = history.shape[1], np.arange(len(v))
    moved = np.sqrt(((history[now] - history) ** 2).sum(2).astype(np.float64))  # (round, centroid): total displacement since
    slack = moved[seen, np.arange(k)] + MARGIN
    root = np.sqrt(dist.astype(np.float64))
    low, up = root * (1 - MARGIN) - slack, (root * (1 + MARGIN) + slack)[rows, own]
    low[rows, own] = np.inf
    open_ = np.flatnonzero(low.min(1) <= up)
    if not len(open_):
        return own

    def evaluate(i: np.ndarray, j: np.ndarray | int) -> None:
        gap = v[i].astype(np.int64) - history[now][j]
        dist[i, j], seen[i, j] = (gap * gap).sum(1), now

    evaluate(open_, own[open_])
    up[open_] = np.sqrt(dist[open_, own[open_]].astype(np.float64)) * (1 + MARGIN) + MARGIN
    fails = low[open_] <= up[open_, None]
    for j in range(k):
        if len(i := open_[fails[:, j]]):
            evaluate(i, j)
    near = np.where(seen[open_] == now, dist[open_], np.iinfo(np.int64).max)  # the rest is farther by its bound
    out = own.copy()
    out[open_] = near.argmin(1)  # the first of equals: the smaller number
    return out


def _matrix(column: pa.Array, rows: int, kind) -> np.ndarray:
    return np.array(column.flatten()).astype(kind).reshape(rows, -1)


def _lists(x: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(np.ascontiguousarray(x).ravel(), kind))


def assigned(state: DataFrame, history: np.ndarray, last: bool) -> DataFrame:
    """(id, v, own, dist, seen): every vector under the newest centroids of ``history``.

    ``last`` also brings the own distance up to date where no bound had asked for it."""
    ship_package(state.sparkSession)

    def run(batches):
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            v = _matrix(b.column(1), n, np.int64)
            if len(history) == 1:
                dist = squared(v, history[0])
                own, seen = dist.argmin(1), np.zeros(dist.shape, np.int64)
            else:
                dist, seen = _matrix(b.column(3), n, np.int64), _matrix(b.column(4), n, np.int64)
                own = reassign(v, np.array(b.column(2)).astype(np.int64), dist, seen, history)
            if last:
                gap = v - history[-1][own]
                dist[np.arange(n), own], seen[np.arange(n), own] = (gap * gap).sum(1), len(history) - 1
            yield pa.record_batch([b.column(0), b.column(1), pa.array(own.astype(np.int32)), _lists(dist, pa.int64()), _lists(seen.astype(np.int32), pa.int32())],
                                  names=["id", "v", "own", "dist", "seen"])

    return state.mapInArrow(run, T.StructType([state.schema["id"], state.schema["v"], *_STATE]))


_STATE = [T.StructField("own", T.IntegerType()), T.StructField("dist", T.ArrayType(T.LongType())), T.StructField("seen", T.ArrayType(T.IntegerType()))]


def recentred(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """floor(sum / count) of each centroid's vectors; an empty one stays.  k rows reach the driver."""
    dims = centroids.shape[1]
    sums = state.groupBy("own").agg(F.count(F.lit(1)).alias("n"), F.array(*[F.sum(F.col("v")[i]) for i in range(dims)]).alias("s"))
    out = centroids.copy()
    for r in sums.collect():
        out[r.own] = [s // r.n for s in r.s]
    return out


def rounds(points: DataFrame, first: np.ndarray, n: int):
    """Yields (written state, centroid history) after each of ``n`` rounds' assignments and the last one."""
    history, state, old = first[None], points, None
    for r in range(n + 1):
        state = written(assigned(state, history, last=r == n), "ns-state")
        if old is not None:
            drop_written(points.sparkSession, old)
        old = state
        yield state, history
        if r < n:
            history = np.concatenate([history, recentred(state, history[-1])[None]])


def cluster(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", k: int = 16, n_rounds: int = 3, dims: int = 64,
            scale: int = 64, seed: str = "1") -> DataFrame:
    """Per vector: id, cluster, distance (squared), cluster_inertia, inertia and centroid_sha256."""
    spark = df.sparkSession
    points = quantised(df, id_col, vector, dims, scale)
    first = starts(points, k, seed)
    if not len(first):
        none = points.select("id", *[F.lit(None).cast(t).alias(c) for c, t in _RESULT.items()])
        return none.where(F.lit(False)).withColumnRenamed("id", id_col)
    for state, history in rounds(points, first, n_rounds):
        pass
    own = state.select("id", F.col("own").alias("cluster"), F.expr("dist[own]").alias("distance"))
    per = {r.cluster: r.s for r in own.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # k rows
    digest = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in history[-1]]
    facts = spark.createDataFrame([(j, s, sum(per.values()), digest[j]) for j, s in per.items()],
                                  "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    out = own.join(F.broadcast(facts), "cluster")  # k rows
    return out.select("id", *_RESULT).withColumnRenamed("id", id_col)


_RESULT = {"cluster": "int", "distance": "long", "cluster_inertia": "long", "inertia": "long", "centroid_sha256": "string"}
