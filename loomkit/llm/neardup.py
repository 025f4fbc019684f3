"""Near-duplicate documents: MinHash signatures, multi-index Hamming join, exact confirmation.

A text's 5-word shingle set gets ``LANES`` min-hash lanes of 32 bits.  The first
``CHUNKS * WIDTH`` lanes are the signature for the index, and the distance of two
signatures is the number of lanes in which they differ.  They are cut into
``CHUNKS`` chunks; by the pigeonhole principle two signatures at distance of at most
``CHUNKS * (ERRORS + 1) - 1`` have a chunk with ``ERRORS`` differing lanes at most.
All ways to leave ``ERRORS`` lanes out of a chunk are enumerated as keys, so all
pairs within that distance share a key: 23 of 40 lanes, which two sets of
similarity 0.75 (10 expected) exceed with a chance of about 2 in a million.

One bit of each of the ``LANES`` lanes makes a second signature whose Hamming
distance screens pairs in the JVM before texts are fetched (38 of 128; 16 expected
at 0.75).  Links are confirmed on the full sets: 100 * intersection >= 75 * union.

Texts with equal sets are one node.  Pairs are never expanded inside a bucket: first
every node is compared with three hubs at most.  A bucket's hub is its most central
node, the one that shares most keys with other nodes; a node takes the most and the
least central hub of its buckets and the most frequent one.  The
confirmed links make components.  Then the pairs of a bucket that are still in
different components are screened where they meet, and only those that pass are
rows: the screen is a longer bit signature and an exact bound, as no intersection
exceeds the number of a set's shingles that any other set in question has.  So a
large group costs three comparisons a member, and no link is lost.  Buckets are cut by
set size, as linked sets differ by a third at most, and a cut with more than ``CELL``
nodes is dealt out over several tasks.

Defined results: null or wordless text has size 0 and links with nothing; rows with
equal ids are rows of their own, but of those with an equal set, too, ``drop_near_copies`` keeps
one (that whose JSON text has the smallest SHA-256); a component's id is its smallest id, nulls last;
an empty table gives an empty result; other columns are carried along untouched.
"""

from __future__ import annotations

import hashlib
import zlib
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomkit.session import ship_package

from .common import bytes_of, col, drop_written, text_or_empty, unpack_row, whole_row, written
from .components import components
from .shingles import mixed, shingle_sets

LANES = 128
CHUNKS, WIDTH, ERRORS = 8, 5, 2
MOST_BITS = 38
CELL = 4096
LONG_BITS, MOST_LONG_BITS = 2048, 335  # 256 expected at 0.75; 5.3 standard deviations more
_RNG = np.random.default_rng(75)
_XOR = _RNG.integers(0, 1 << 64, LANES, dtype=np.uint64)
_MUL = _RNG.integers(0, 1 << 63, LANES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PATTERNS = [[c * WIDTH + x for x in keep] for c in range(CHUNKS) for keep in combinations(range(WIDTH), WIDTH - ERRORS)]


def minima(sets: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Lane minima (rows, LANES) of non-empty sets that lie one after another."""
    out = np.empty((len(offsets) - 1, LANES), np.uint64)
    work = np.empty(len(sets), np.uint64)
    for i in range(LANES):
        np.bitwise_xor(sets, _XOR[i], out=work)
        np.multiply(work, _MUL[i], out=work)
        out[:, i] = np.minimum.reduceat(work, offsets[:-1])
    return out


def _digests(sets: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    return [hashlib.blake2b(sets[a:b].tobytes(), digest_size=16).digest() if b > a else b""
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]


def sketch(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """Per row: id, n (set size), digest of the set (empty: none), lanes, and 128 bits as two longs."""
    ship_package(docs.sparkSession)

    def run(batches):
        for b in batches:
            data, off = bytes_of(b.column(1))
            for lo, sets, at in shingle_sets(data, off):
                rows = len(at) - 1
                some = np.flatnonzero(np.diff(at))
                low = minima(sets, np.append(at[some], len(sets))) if len(some) else np.zeros((0, LANES), np.uint64)
                bits = np.packbits(((low >> np.uint64(40)) & np.uint64(1)).astype(np.uint8), axis=1).view("<i8").reshape(len(some), LANES // 64)
                two = np.zeros((rows, LANES // 64), np.int64)
                two[some] = bits
                lanes = [b""] * rows
                for i, x in zip(some.tolist(), (low[:, :CHUNKS * WIDTH] >> np.uint64(32)).astype("<u4"), strict=True):
                    lanes[i] = x.tobytes()
                yield pa.record_batch([b.column(0).slice(lo, rows), pa.array(np.diff(at)), pa.array(_digests(sets, at), pa.binary()),
                                       pa.array(lanes, pa.binary()), pa.array(two[:, 0]), pa.array(two[:, 1])],
                                      names=["id", "n", "digest", "lanes", "b1", "b2"])

    rows = docs.select(col(id_col).alias("id"), text_or_empty(text).alias("text"))
    return rows.mapInArrow(run, T.StructType([
        T.StructField("id", rows.schema["id"].dataType), T.StructField("n", T.LongType()), T.StructField("digest", T.BinaryType()),
        T.StructField("lanes", T.BinaryType()), T.StructField("b1", T.LongType()), T.StructField("b2", T.LongType())]))


def index_keys(nodes: DataFrame) -> DataFrame:
    """(p, key, node): every node under each of its chunk readings with ``ERRORS`` lanes left out."""
    ship_package(nodes.sparkSession)

    def run(batches):
        salt = mixed(np.arange(1, len(_PATTERNS) + 1, dtype=np.uint64) * _MUL[0])
        for b in batches:
            lanes = np.frombuffer(b"".join(b.column(1).to_pylist()), "<u4").reshape(b.num_rows, -1).astype(np.uint64)
            keys = np.empty((b.num_rows, len(_PATTERNS)), np.uint64)
            for i, pattern in enumerate(_PATTERNS):
                k = np.full(b.num_rows, salt[i])
                for lane in pattern:
                    k = mixed((k ^ lanes[:, lane]) * _MUL[1])
                keys[:, i] = k
            yield pa.record_batch([b.column(0), pa.FixedSizeListArray.from_arrays(pa.array(keys.view(np.int64).ravel()), len(_PATTERNS)).cast(
                pa.list_(pa.int64()))], names=["node", "keys"])

    return nodes.select("node", "lanes").mapInArrow(run, "node long, keys array<long>").select(F.posexplode("keys").alias("p", "key"), "node")


def texts_by_digest(docs: DataFrame, text: str) -> DataFrame:
    """(digest, z): the set's digest and the compressed text of every row with a set."""
    ship_package(docs.sparkSession)

    def run(batches):
        for b in batches:
            data, off = bytes_of(b.column(0))
            for lo, sets, at in shingle_sets(data, off):
                d = _digests(sets, at)
                keep = [i for i, x in enumerate(d) if x]
                yield pa.record_batch([pa.array([d[i] for i in keep], pa.binary()),
                                       pa.array([zlib.compress(data[off[lo + i]:off[lo + i + 1]].tobytes(), 1) for i in keep], pa.binary())],
                                      names=["digest", "z"])

    return docs.select(text_or_empty(text).alias("text")).mapInArrow(run, "digest binary, z binary")


def fetched(wanted: DataFrame, docs: DataFrame, text: str, nodes: DataFrame) -> DataFrame:
    """(node, z): the compressed text of each of the ``wanted`` nodes, written."""
    digests = written(wanted.join(nodes.select("node", "digest").hint("merge"), "node"), "near-wanted")
    found = texts_by_digest(docs, text).join(digests.hint("merge"), "digest").groupBy("node").agg(F.first("z").alias("z"))
    found = written(found, "near-texts", "uncompressed")
    drop_written(docs.sparkSession, digests)
    return found


def confirmed(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """Those (a, b) of ``pairs`` whose full sets have 100 * intersection >= 75 * union."""

    def run(batches):
        known, recent, size = (None, None), {}, 0  # sets at hand, bounded by their shingles
        for b in batches:
            keep = []
            for i, (j, k, za, zb) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3), strict=True)):
                if known[0] != k:
                    known = (k, _set(zb.as_py()))
                if (x := recent.get(j)) is None:
                    if size > 4_000_000:
                        recent.clear()
                        size = 0
                    x = recent[j] = _set(za.as_py())
                    size += len(x)
                y = known[1]
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= 75 * (len(x) + len(y) - both):
                    keep.append(i)
            yield pa.record_batch([b.column(0).take(pa.array(keep, pa.int64())), b.column(1).take(pa.array(keep, pa.int64()))], names=["a", "b"])

    one = pairs.join(found.select(F.col("node").alias("a"), F.col("z").alias("za")).hint("merge"), "a")
    two = one.join(found.select(F.col("node").alias("b"), F.col("z").alias("zb")).hint("merge"), "b")
    return written(two.select("a", "b", "za", "zb").mapInArrow(run, "a long, b long"), "near-links")


def long_sketches(found: DataFrame) -> DataFrame:
    """(node, k, sets): ``LONG_BITS`` min-hash bits as longs, and the set itself."""

    def run(batches):
        rng = np.random.default_rng(76)
        xor = rng.integers(0, 1 << 64, LONG_BITS, dtype=np.uint64)
        mul = rng.integers(0, 1 << 63, LONG_BITS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        for b in batches:
            for lo in range(0, b.num_rows, 64):
                part = b.slice(lo, 64)
                sets = [_set(z.as_py()) for z in part.column(1)]
                at = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
                every = np.concatenate(sets)
                bits = np.empty((len(sets), LONG_BITS), np.uint8)
                for i in range(LONG_BITS):
                    bits[:, i] = (np.minimum.reduceat((every ^ xor[i]) * mul[i], at[:-1]) >> np.uint64(40)) & np.uint64(1)
                k = np.packbits(bits, axis=1).view("<i8").reshape(len(sets), -1)
                yield pa.record_batch([part.column(0), pa.array(list(k), pa.list_(pa.int64())), pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64()))],
                                      names=["node", "k", "sets"])

    return found.mapInArrow(run, "node long, k array<long>, sets array<long>")


def shared_counts(sets: DataFrame) -> DataFrame:
    """(node, c): how many of a node's shingles another of these nodes has too.

    No intersection with any of them is larger, which bounds a pair's similarity exactly."""
    each = sets.select("node", F.explode("sets").alias("h"))
    twice = written(each.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"), "near-shared")
    return each.join(twice.hint("merge"), "h").groupBy("node").agg(F.count(F.lit(1)).alias("c"))


def _set(z: bytes) -> np.ndarray:
    raw = np.frombuffer(zlib.decompress(z), np.uint8)
    return next(shingle_sets(raw, np.array([0, len(raw)])))[1]


def _screen(x: str, y: str):
    """Set sizes and bit signatures allow a similarity of 0.75."""
    return F.expr(f"100 * least({x}.n, {y}.n) >= 75 * greatest({x}.n, {y}.n) and "
                  f"bit_count({x}.b1 ^ {y}.b1) + bit_count({x}.b2 ^ {y}.b2) <= {MOST_BITS}")


def _lane_list(nodes: DataFrame) -> DataFrame:
    """(node, l): the index lanes as an array of ints."""

    def run(batches):
        for b in batches:
            lanes = [np.frombuffer(x, "<i4") for x in b.column(1).to_pylist()]
            yield pa.record_batch([b.column(0), pa.array(lanes, pa.list_(pa.int32()))], names=["node", "l"])

    return nodes.select("node", "lanes").mapInArrow(run, "node long, l array<int>")


def _first_meeting() -> F.Column:
    """Reading x.p is the first in which the two signatures meet, so a pair is made once.

    (Written with array functions: spelt out, the compiled condition grows too large for the JVM to optimise.)"""
    n = CHUNKS * WIDTH
    masks = ", ".join(f"{sum(1 << (n - 1 - i) for i in pattern)}L" for pattern in _PATTERNS)
    same = "aggregate(zip_with(x.l, y.l, (a, b) -> if(a = b, 1L, 0L)), 0L, (m, e) -> m * 2 + e)"
    return F.expr(f"transform(array({same}), m -> array_position(transform(array({masks}), q -> (m & q) = q), true))[0] = x.p + 1")


def _meet(left: DataFrame, above: int, on: F.Column, how: str) -> DataFrame:
    """x joined with y for each two rows of a bucket whose size classes allow a link (y's class is ``above`` x's at most).

    The cells (bucket and size class) with more than CELL rows are dealt out: x by its node, y to every share."""
    cell = ["key", "cell"]
    rows = left.withColumn("cell", F.col("size"))
    hot = written(rows.groupBy(*cell).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > CELL).select(
        *cell, F.ceil(F.col("rows") / CELL).cast("int").alias("shares")), "near-hot")

    def shared(df: DataFrame) -> DataFrame:
        return df.join(hot, cell, "left").withColumn("shares", F.coalesce("shares", F.lit(1)))

    x = shared(rows).withColumn("share", F.pmod(F.xxhash64("node"), "shares").cast("int"))
    y = left.withColumn("cell", F.explode(F.expr(f"sequence(size - {above}, size + 1)")))
    y = shared(y).withColumn("share", F.explode(F.expr("sequence(0, shares - 1)")))
    x, y = x.alias("x").hint("merge"), y.alias("y").hint("merge")
    return x.join(y, F.expr("x.key = y.key and x.cell = y.cell and x.share = y.share") & on, how)


def node_components(docs: DataFrame, text: str, nodes: DataFrame) -> DataFrame:
    """(node, comp) of every node with a link."""
    spark = docs.sparkSession
    keys = index_keys(nodes)
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("others")).where("others > 1")
    shared = written(shared, "near-buckets")
    member = written(keys.join(shared.hint("merge"), "key"), "near-members")
    drop_written(spark, shared)
    slim = nodes.select("node", "n", "b1", "b2")
    central = member.groupBy("node").agg(F.sum("others").alias("c"))
    tops = written(member.join(central.hint("merge"), "node").groupBy("key").agg(F.max(F.struct("c", "node")).alias("top")), "near-tops")
    hubs = member.join(tops.hint("merge"), "key").groupBy("node").agg(
        F.max("top").getField("node").alias("hi"), F.mode("top.node", True).alias("often"), F.min("top").getField("node").alias("lo"))
    pairs = hubs.select("node", F.explode(F.array_distinct(F.array("lo", "often", "hi"))).alias("hub")).where("node <> hub")
    pairs = pairs.select(F.greatest("node", "hub").alias("a"), F.least("node", "hub").alias("b")).distinct()
    x, y = slim.alias("x"), slim.alias("y")
    stars = pairs.join(x, F.col("a") == F.col("x.node")).join(y, F.col("b") == F.col("y.node")).where(_screen("x", "y")).select("a", "b")
    stars = written(stars, "near-stars")
    ends = stars.select(F.col("a").alias("node")).unionByName(stars.select(F.col("b").alias("node"))).distinct()
    found = fetched(ends, docs, text, nodes)
    links = confirmed(stars, found)
    drop_written(spark, found)
    comp = written(components(links), "near-comp")

    # pairs of a bucket that are still in different components
    at = member.select("p", "key", "node").join(comp, "node", "left").select("p", "key", "node", F.coalesce("comp", "node").alias("comp"))
    at = written(at.join(slim, "node"), "near-members")
    open_ = at.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("key")
    left = at.join(open_.hint("merge"), "key").withColumn("size", F.floor(F.log("n") / F.log(F.lit(4 / 3))).cast("int"))
    left = written(left, "near-open")
    apart = F.expr("x.comp <> y.comp") & _screen("x", "y")
    some = written(_meet(left, 1, apart, "left_semi").select("node").distinct(), "near-some")  # nodes with any such partner
    drop_written(spark, member, at)
    if some.isEmpty():
        return comp
    found = fetched(some, docs, text, nodes)
    sets = written(long_sketches(found), "near-sets")
    more = shared_counts(sets).join(sets.select("node", "k").hint("merge"), "node").join(_lane_list(nodes).hint("merge"), "node")
    left = written(left.join(more.hint("merge"), "node"), "near-open")
    bound = F.expr("100 * least(x.c, y.c) >= 75 * (x.n + y.n - least(x.c, y.c))")
    bits = F.expr(f"aggregate(zip_with(x.k, y.k, (a, b) -> bit_count(a ^ b)), 0, (s, v) -> s + v) <= {MOST_LONG_BITS}")
    once = F.expr("x.comp <> y.comp and (x.size > y.size or x.node > y.node)")
    rest = _meet(left, 0, once & _screen("x", "y") & bound & bits & _first_meeting(), "inner")
    rest = written(rest.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")), "near-rest")
    if rest.isEmpty():
        return comp
    return components(links.unionByName(confirmed(rest, found)))


def _classes(docs: DataFrame, id_col: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(sketch rows, per digest: component id and the digest of the component's first document)."""
    rows = written(sketch(docs, id_col, text), "near-sketch")
    same = rows.where("n > 0").groupBy("digest").agg(
        F.min("id").alias("id"), F.first("n").alias("n"), F.first("lanes").alias("lanes"), F.first("b1").alias("b1"), F.first("b2").alias("b2"))
    nodes = written(same.withColumn("node", F.monotonically_increasing_id()), "near-nodes")
    comp = node_components(docs, text, nodes)
    member = nodes.select("node", "digest", "id").join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    member = written(member, "near-class")
    first = F.min(F.struct(F.isnull("id").alias("no"), F.col("id"), F.col("digest"))).alias("f")
    per = member.groupBy("comp").agg(first)
    per = written(per.select("comp", F.col("f.id").alias("component_id"), F.col("f.digest").alias("first_digest")), "near-first")
    return rows, written(member.join(per.hint("merge"), "comp").select("digest", "component_id", "first_digest"), "near-by-digest")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, n_shingles, component_id (its own id if nothing is linked) and kept."""
    rows, by = _classes(docs, id_col, text)
    out = rows.select("id", "n", "digest").join(by.hint("merge"), "digest", "left")
    cid = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), cid.alias("component_id"), F.col("id").eqNullSafe(cid).alias("kept"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each component (the smallest id); rows without words stay; columns as they were."""
    _, by = _classes(docs, id_col, text)
    keep = by.where(F.col("digest") == F.col("first_digest")).select(F.col("digest").alias("digest"), F.col("component_id").alias("id"))

    def run(batches):
        at = TaskContext.get().partitionId() << 33
        for b in batches:
            data, off = bytes_of(b.column(1))
            d: list[bytes] = []
            for _, sets, cut in shingle_sets(data, off):
                d += _digests(sets, cut)
            own = [0 if x else at + i for i, x in enumerate(d, 1)]
            at += len(d)
            yield pa.record_batch([b.column(0), pa.array(d, pa.binary()), pa.array(own, pa.int64())], names=["row", "digest", "own"])

    src = docs.select(whole_row(docs).alias("row"), text_or_empty(text).alias("text"))
    rows = src.mapInArrow(run, T.StructType([T.StructField("row", src.schema["row"].dataType), T.StructField("digest", T.BinaryType()),
                                             T.StructField("own", T.LongType())])).withColumn("id", F.col("row").getField(id_col))
    r, k = rows.alias("r"), keep.withColumn("hit", F.lit(True)).alias("k").hint("merge")
    out = r.join(k, F.expr("r.digest = k.digest and r.id <=> k.id"), "left").where(F.col("hit") | (F.col("own") > 0))
    first = F.min_by("r.row", F.sha2(F.to_json("r.row"), 256)).alias("row")  # an id that repeats with an equal set is one document
    return unpack_row(out.groupBy("r.digest", "r.id", "r.own").agg(first), "row", docs.columns)
