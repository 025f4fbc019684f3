"""Approximate nearest neighbours by inner product: one navigable small-world graph per shard.

Distinct vectors are dealt by hash into shards of about ``SHARD_ROWS``.  Each
shard becomes a hierarchy of graphs kept as flat neighbour arrays (one row of
node numbers per node and level, -1 padded).  Levels are drawn geometrically;
links are the nearest nodes of the level thinned by the diversity rule (a link is
kept if its end is nearer to the node than to any kept one), plus reverse links.
Where norms differ, every node of the lowest level has links to its largest inner products, too.
A level whose nearest links leave a tight group to itself (more near copies than links)
is mended: a group of mutual links without a node on the level above sends one there,
and so does whatever cannot be reached from the level above.  So every group has an
entry, and a search of the lowest level starts from the best entries of several groups.
Vectors get one extra component that makes all norms of a shard equal, so nearest
by inner product is nearest by distance.

A search task takes one shard and one block of queries and walks the levels down
in lockstep for all queries of the block, keeping the ``ef`` best nodes of each
(on the last level above the lowest, all nodes are scored).  Large groups of near copies could
fill those places and hide better nodes behind them, so a second walk leaves such groups out.
Shard results are rescored in double precision and merged per query.

Equal vectors are one node with their ``k + 1`` smallest ids; no other id of theirs
could be among the ``k`` nearest.  Defined results: vectors null, empty, zero or
with a null or non-finite component take no part, nor do rows without an id; a
repeated id counts once per different vector, and as a query with its smallest
vector; only vectors of a query's own length are compared with it; ties go to the
smaller id; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomkit.session import ship_package

from .common import col, written

SHARD_ROWS = 16384
BLOCK_ROWS = 4096
LINKS = 24
CANDIDATES = 48
EF = 128
EF_UPPER = 16
GROUP = 8  # mutual groups of this size get an entry of their own
STARTS, PER_GROUP = 24, 6  # where a search of the lowest level starts


def usable(vector) -> F.Column:
    ok = F.forall(vector, lambda x: F.isnotnull(x) & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return F.coalesce((F.size(vector) > 0) & ok & F.exists(vector, lambda x: x != 0), F.lit(False))


def _level_links(x: np.ndarray, nodes: np.ndarray, links: int) -> np.ndarray:
    """Neighbour rows (node numbers, -1 padded) of ``nodes`` among themselves."""
    n = len(nodes)
    out = np.full((n, 2 * links), -1, np.int32)
    if n < 2:
        return out
    v, c = x[nodes], min(CANDIDATES, n - 1)
    chosen, near = np.full((n, links), -1, np.int32), np.full((n, links), -np.inf, np.float32)
    for lo in range(0, n, 512):
        sims = v[lo:lo + 512] @ v.T
        own = np.arange(len(sims))
        sims[own, lo + own] = -np.inf
        cand = np.argpartition(-sims, c - 1, axis=1)[:, :c]
        s = np.take_along_axis(sims, cand, 1)
        order = np.lexsort((cand, -s), axis=1)
        cand, s = np.take_along_axis(cand, order, 1), np.take_along_axis(s, order, 1)
        between = np.einsum("bid,bjd->bij", v[cand], v[cand], optimize=True)
        keep = np.zeros(s.shape, bool)
        for j in range(c):
            blocked = (keep[:, :j] & (between[:, j, :j] >= s[:, j, None])).any(1) if j else False
            keep[:, j] = ~np.asarray(blocked)
        rank = np.argsort(~keep, axis=1, kind="stable")[:, :links]  # diverse ones first, then the nearest others
        chosen[lo:lo + 512, :rank.shape[1]] = np.take_along_axis(cand, rank, 1)
        near[lo:lo + 512, :rank.shape[1]] = np.take_along_axis(s, rank, 1)
    out[:, :links] = chosen
    src, slot = np.nonzero(chosen >= 0)
    dst, sim = chosen[src, slot], near[src, slot]
    order = np.lexsort((src, -sim, dst))
    src, dst = src[order], dst[order]
    place = np.arange(len(dst)) - np.searchsorted(dst, dst)
    ok = place < links
    out[dst[ok], links + place[ok]] = src[ok]
    return np.where(out >= 0, nodes[out], -1).astype(np.int32)


def _mutual_groups(links: np.ndarray) -> np.ndarray:
    """A group number per row: rows that reach each other over links that go both ways."""
    n = len(links)
    src, slot = np.nonzero(links >= 0)
    dst = links[src, slot]
    both = np.isin(src.astype(np.int64) * n + dst, dst.astype(np.int64) * n + src)
    src, dst, group = src[both], dst[both], np.arange(n)
    while True:
        low = group.copy()
        np.minimum.at(low, src, group[dst])
        low = low[low]
        if (low == group).all():
            return group
        group = low


def _reached(links: np.ndarray, at: np.ndarray, seen: np.ndarray) -> None:
    """Mark in ``seen`` what the rows ``at`` lead to."""
    while len(at):
        at = np.unique(links[at])
        at = at[at >= 0]
        at = at[~seen[at]]
        seen[at] = True


def entries(x: np.ndarray, links: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Rows of a level that need a node on the level above, where the rows ``above`` are."""
    group = _mutual_groups(links[:, :LINKS])  # without the reverse links, which also lead out of a tight group
    sizes = np.bincount(group, minlength=len(x))
    has = np.zeros(len(x), bool)
    has[group[above]] = True
    new = [int((m := np.flatnonzero(group == g))[np.argmax(x[m] @ x[m].mean(0))]) for g in np.flatnonzero((sizes >= GROUP) & ~has)]
    seen = np.zeros(len(x), bool)
    start = np.concatenate([above, np.array(new, np.int64)]).astype(np.int64)
    seen[start] = True
    _reached(links, start, seen)
    while not seen.all():
        one = np.flatnonzero(~seen)[:1]
        new.append(int(one[0]))
        seen[one] = True
        _reached(links, one, seen)
    return np.array(new, np.int64)


def build_graph(vectors: np.ndarray, seed: int = 5) -> list[tuple[np.ndarray, np.ndarray]]:
    """[(nodes, neighbour rows)] from the lowest level (all nodes) to the highest."""
    x = lifted(vectors)
    levels = np.floor(-np.log(1 - np.random.default_rng(seed).random(len(x))) / math.log(LINKS)).astype(int)
    out, l = [], 0
    while l == 0 or (len(out[-1][0]) > LINKS and (levels >= l).any()):
        nodes = np.flatnonzero(levels >= l)
        links = _level_links(x, nodes, LINKS)
        if len(nodes) > LINKS:
            here = np.full(len(x), -1)
            here[nodes] = np.arange(len(nodes))
            more = entries(x[nodes], np.where(links >= 0, here[links], -1), np.flatnonzero(levels[nodes] > l))
            levels[nodes[more]] = l + 1
        if l == 0 and (x[:, -1] > 1e-6 * np.abs(x).max()).any():
            links = np.column_stack([links, _largest_products(x[:, :-1], LINKS)])
        out.append((nodes.astype(np.int32), links))
        l += 1
    return out


def _largest_products(v: np.ndarray, links: int) -> np.ndarray:
    """The ``links`` other rows with the largest inner product with each row."""
    c = min(links, len(v) - 1)
    out = np.full((len(v), links), -1, np.int32)
    for lo in range(0, len(v) * (c > 0), 512):
        sims = v[lo:lo + 512] @ v.T
        sims[np.arange(len(sims)), lo + np.arange(len(sims))] = -np.inf
        out[lo:lo + 512, :c] = np.argpartition(-sims, c - 1, axis=1)[:, :c]
    return out


def lifted(vectors: np.ndarray) -> np.ndarray:
    sq = (vectors * vectors).sum(1)
    return np.column_stack([vectors, np.sqrt(np.maximum(sq.max() - sq, 0))]).astype(np.float32)


def _tight(x: np.ndarray, group: np.ndarray, least: int, cosine: float = 0.9) -> np.ndarray:
    """Nodes of groups of ``least`` or more whose members are near copies of each other (``x`` has equal norms)."""
    names, at, sizes = np.unique(group, return_inverse=True, return_counts=True)
    total = np.zeros((len(names), x.shape[1]))
    np.add.at(total, at, x)
    near = (total * total).sum(1) / sizes ** 2 > cosine * (x[0] * x[0]).sum()
    return (near & (sizes >= least))[at]


def _beam(x, links, q, start, ef, expand=4, skip=None):
    """The ``ef`` best nodes found for each query, from ``start`` (nodes per query), best first; -1 padded."""
    rows = np.arange(len(q))[:, None]
    seen = np.zeros((len(q), len(x) + 1), bool)
    seen[:, -1] = True  # the padding
    if skip is not None:
        seen[:, :-1] = skip
    pool = np.full((len(q), ef), -1, np.int32)
    score = np.full((len(q), ef), -np.inf, np.float32)
    done = np.ones((len(q), ef), bool)
    new = np.concatenate([start, links[start].reshape(len(q), -1)], 1)  # every start is followed, however many better ones there are
    while True:
        new = np.sort(new, axis=1)
        twice = np.zeros(new.shape, bool)
        twice[:, 1:] = new[:, 1:] == new[:, :-1]
        new = np.where(twice | seen[rows, new], -1, new)
        seen[rows, new] = True
        s = np.einsum("qd,qkd->qk", q, x[new], optimize=True)
        s[new < 0] = -np.inf
        ids, ss = np.concatenate([pool, new], 1), np.concatenate([score, s], 1)
        dd = np.concatenate([done, new < 0], 1)
        top = np.argsort(-ss, axis=1, kind="stable")[:, :ef]
        pool, score, done = np.take_along_axis(ids, top, 1), np.take_along_axis(ss, top, 1), np.take_along_axis(dd, top, 1)
        if done.all():
            return pool
        pick = np.argsort(done, axis=1, kind="stable")[:, :expand]
        fresh = ~np.take_along_axis(done, pick, 1)
        np.put_along_axis(done, pick, True, 1)
        at = np.where(fresh, np.take_along_axis(pool, pick, 1), len(x))
        new = links[at].reshape(len(q), -1)


def search_graph(vectors: np.ndarray, graph, queries: np.ndarray, ef: int = EF) -> np.ndarray:
    """Node numbers [query, ef or twice as many], best first, -1 padded."""
    x = np.vstack([lifted(vectors), np.zeros((1, vectors.shape[1] + 1), np.float32)])
    q = np.column_stack([queries, np.zeros(len(queries))]).astype(np.float32)
    n, out = len(vectors), []
    tables = []
    for nodes, rows in graph:
        t = np.full((n + 1, rows.shape[1]), -1, np.int32)
        t[nodes] = rows
        tables.append(t)
    group = _mutual_groups(tables[0][:-1, :LINKS]) if len(tables) > 1 and n > ef else None
    skip = None
    if group is not None:
        skip = _tight(x[:-1], group, ef // 4)
        rest = graph[1][0][~skip[graph[1][0]]]
        skip = skip if skip.any() and len(rest) else None
    for lo in range(0, len(q), 64):
        part = q[lo:lo + 64]
        start = np.tile(np.arange(n, dtype=np.int32) if n <= ef else graph[-1][0], (len(part), 1))
        for t in tables[:1:-1]:
            start = _beam(x[:-1], t, part, start, EF_UPPER)
        if group is not None:
            start = _starts(x, graph[1][0], group, part)
        found = _beam(x[:-1], tables[0], part, start, ef)
        if skip is not None:
            found = _merged(x, part, found, _beam(x[:-1], tables[0], part, _starts(x, rest, group, part), ef, skip=skip))
        out.append(found)
    return np.concatenate(out)


def _merged(x: np.ndarray, q: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The nodes of both lists, each once, best first; -1 padded."""
    both = np.sort(np.concatenate([a, b], 1), axis=1)
    both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
    score = np.einsum("qd,qkd->qk", q, x[both], optimize=True)
    score[both < 0] = -np.inf
    return np.take_along_axis(both, np.argsort(-score, axis=1, kind="stable"), 1)


def _starts(x: np.ndarray, nodes: np.ndarray, group: np.ndarray, q: np.ndarray) -> np.ndarray:
    """The best ``nodes`` of each query, ``PER_GROUP`` of a group at most; -1 padded."""
    order = np.argsort(-(q @ x[nodes].T), axis=1, kind="stable")
    out = np.full((len(q), STARTS), -1, np.int32)
    for i, o in enumerate(order):
        g = group[nodes[o]]
        by = np.argsort(g, kind="stable")
        rank = np.empty(len(g), np.int64)
        rank[by] = np.arange(len(g)) - np.searchsorted(g[by], g[by])
        top = nodes[o[rank < PER_GROUP][:STARTS]]
        out[i, :len(top)] = top
    return out


INDEX = "dim int, shard int, n int, ids binary, id_counts binary, vectors binary, nodes array<binary>, links array<binary>"


def build_index(points: DataFrame) -> DataFrame:
    """(dim, shard, vector, ids) rows -> one row of flat arrays per shard."""

    def build(table: pa.Table) -> pa.Table:
        t = table.sort_by([("first", "ascending")])
        dim, shard = t["dim"][0].as_py(), t["shard"][0].as_py()
        v = np.array(t["vector"].combine_chunks().flatten(), np.float64).reshape(-1, dim)
        ids = t["ids"].combine_chunks()
        graph = build_graph(v)
        one = lambda a, kind: pa.array([a.astype(kind).tobytes()], pa.binary())
        return pa.table([pa.array([dim], pa.int32()), pa.array([shard], pa.int32()), pa.array([len(v)], pa.int32()),
                         one(np.array(ids.flatten()), "<i8"), one(np.array(ids.value_lengths()), "<i4"), one(v, "<f8"),
                         pa.array([[g[0].astype("<i4").tobytes() for g in graph]], pa.list_(pa.binary())),
                         pa.array([[g[1].astype("<i4").tobytes() for g in graph]], pa.list_(pa.binary()))],
                        names=["dim", "shard", "n", "ids", "id_counts", "vectors", "nodes", "links"])

    return points.groupBy("dim", "shard").applyInArrow(build, INDEX)


def nearest(rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding", every: int = 20, k: int = 20, ef: int = EF,
            shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The ``k`` nearest found of every query (ids divisible by ``every``): query_id, rank, id, score."""
    spark = rows.sparkSession
    ship_package(spark)
    good = rows.select(col(id_col).cast("long").alias("id"), col(vector).cast("array<double>").alias("vector"))
    good = good.where(F.isnotnull("id") & usable(F.col("vector")))
    rank = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    few = good.distinct().withColumn("r", rank).where(F.col("r") <= k + 1)
    nodes = written(few.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids")), "hnsw-nodes")  # at most k + 1 ids each
    shards = max(1, -(-nodes.count() // shard_rows))
    points = nodes.select(F.size("vector").alias("dim"), F.pmod(F.xxhash64("vector"), F.lit(shards)).cast("int").alias("shard"),
                          "vector", "ids", F.col("ids")[0].alias("first"))
    index = written(build_index(points.repartition(shards, "shard")), "hnsw-index")

    asked = written(good.where(F.col("id") % every == 0).groupBy("id").agg(F.min("vector").alias("vector")), "hnsw-queries")
    blocks = max(1, -(-asked.count() // BLOCK_ROWS))
    per_block = asked.select(F.size("vector").alias("dim"), F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"), "id", "vector")
    per_block = per_block.groupBy("dim", "block").agg(F.collect_list(F.struct("id", "vector")).alias("q"))  # about BLOCK_ROWS each
    left = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = per_block.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

    def search(a: pa.Table, b: pa.Table) -> pa.Table:
        names = ["query_id", "id", "score"]
        schema = pa.schema([("query_id", pa.int64()), ("id", pa.int64()), ("score", pa.float64())])
        if not a.num_rows or not b.num_rows:
            return schema.empty_table()
        r = a.to_pylist()[0]
        v = np.frombuffer(r["vectors"], "<f8").reshape(r["n"], r["dim"])
        ids, counts = np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["id_counts"], "<i4")
        first = np.concatenate([[0], np.cumsum(counts)])
        graph = []
        for nn, ll in zip(r["nodes"], r["links"], strict=True):
            nn = np.frombuffer(nn, "<i4")
            graph.append((nn, np.frombuffer(ll, "<i4").reshape(len(nn), -1)))
        q = b["q"].combine_chunks().flatten()
        qid = np.array(q.field("id"), np.int64)
        qv = np.array(q.field("vector").flatten(), np.float64).reshape(len(qid), r["dim"])
        found = search_graph(v, graph, qv, ef)
        out = []
        for own, vec, at in zip(qid, qv, found, strict=True):
            at = at[at >= 0]
            c = counts[at]
            score = np.repeat(v[at] @ vec, c)
            ends = np.cumsum(c)
            who = ids[np.arange(ends[-1]) + np.repeat(first[at] - (ends - c), c)] if len(at) else ids[:0]
            other = who != own
            who, score = who[other], score[other]
            top = np.lexsort((who, -score))[:k]
            out.append((np.full(len(top), own), who[top], score[top]))
        return pa.table([np.concatenate(x) for x in zip(*out, strict=True)], names=names).cast(schema)

    found = left.groupBy("dim", "shard", "block").cogroup(right.groupBy("dim", "shard", "block")).applyInArrow(
        search, "query_id long, id long, score double")
    best = found.groupBy("query_id", "id").agg(F.max("score").alias("score"))  # an id with several vectors: its best
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", F.col("id").alias(id_col), "score")
