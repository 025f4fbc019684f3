"""Removal of byte strings that occur more than once: a sparse, range-partitioned suffix array.

A ``LENGTH``-byte string that starts at two places anywhere is a repeat, and every
byte it covers goes.  Sorting the suffix of every byte of the corpus would move
hundreds of times its size, so suffixes are sorted at anchors only: of the
``GRAM``-byte strings inside a ``LENGTH``-byte string, the one with the smallest
hash (the leftmost of equals) is its anchor.  Equal strings have their anchor at
the same place, and neighbouring strings mostly share theirs.  Each anchor owns
the interval of starts it is the anchor of, and only anchors whose gram occurs twice
can own a repeat; the gram's hash is a filter, never a decision.

The suffixes at those anchors, with the text to the left that belongs to their
starts, are range-partitioned by their leading bytes (Spark's range partitioner samples
the splitters, and never splits equal leads) and
sorted in each bucket by multikey quicksort, eight bytes to a token.  Neighbours'
common prefixes to the right, and those of the reversed left sides, give for
every start the suffixes it is equal to: it must agree with one on both sides.
Leads that more than a bucket's worth of suffixes begin with are not sorted: they are
compared wherever they lie, by counting the strings at all their starts
(128-bit fingerprints, combined before the shuffle).

Periodic stretches, where a gram repeats inside its own neighbourhood, are found
in the pass that picks the anchors by comparing their bytes, and only the last of such
anchors is sorted.

Defined results: null text is empty; texts shorter than ``LENGTH`` never change;
rows with equal texts are repeats of each other, so a long enough text that occurs
twice goes as a whole; rows with equal ids are rows of their own; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomkit.session import ship_package

from .common import bytes_of, col, drop_written, text_or_empty, written
from .shingles import mixed, powers, prefix_hashes

LENGTH = 400
GRAM = 128
CHUNK = 256 << 10
LEAD = 16
BUCKET_ROWS = 20_000
_LOW = np.uint64(0xFFFFFFFF)


def spans_hash(prefix: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    _, down = powers(len(prefix))
    return (prefix[hi] - prefix[lo]) * down[lo]


def anchors_of(data: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(gram hash, anchor, first start, last start) of one chunk's anchors and merged (first, last) starts of periodic repeats."""
    n, w = len(data), length - gram + 1
    none = np.zeros(0, np.int64)
    if n < length:
        return np.zeros(0, np.int64), none, none, none, (none, none)
    prefix = prefix_hashes(data)
    at = np.arange(n - gram + 1)
    g = mixed(spans_hash(prefix, at, at + gram))
    key = (g & ~_LOW) | at.astype(np.uint64)
    pad = np.full(-(-len(key) // w) * w, np.iinfo(np.uint64).max)
    pad[:len(key)] = key
    grid = pad.reshape(-1, w)
    ahead = np.minimum.accumulate(grid, 1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], 1)[:, ::-1].ravel()
    starts = n - length + 1
    low = np.minimum(back[:starts], ahead[w - 1:w - 1 + starts])
    pos = (low & _LOW).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], pos[1:] != pos[:-1]]))
    last = np.concatenate([first[1:], [starts]]) - 1
    a = pos[first]
    h = g[a]
    # a gram that comes again within the window, with all its owner's strings: a periodic stretch
    step = np.concatenate([a[1:] - a[:-1], [n]])
    again = np.concatenate([h[1:] == h[:-1], [False]]) & (step < w)
    i = np.flatnonzero(again)
    i = i[last[i] + length + step[i] <= n]
    same = np.zeros(len(i), bool)
    for period in np.unique(step[i]).tolist():
        wrong = np.concatenate([[0], np.cumsum(data[:-period] != data[period:])])
        k = np.flatnonzero(step[i] == period)
        same[k] = wrong[last[i[k]] + length] == wrong[first[i[k]]]
    i = i[same]
    keep = np.ones(len(a), bool)
    keep[i] = False
    lone = np.concatenate([[True], np.diff(i) > 1]) if len(i) else np.zeros(0, bool)
    heads = np.flatnonzero(lone)
    ends = np.concatenate([heads[1:], [len(i)]]) - 1 if len(i) else heads
    tail = i[ends]  # a stretch's last starts are equal to the ones a period later
    return h[keep].view(np.int64), a[keep], first[keep], last[keep], (
        np.concatenate([first[i[heads]], first[tail] + step[tail]]), np.concatenate([last[tail], last[tail] + step[tail]]))


def text_key(name: str):
    return F.unhex(F.substring(F.sha2(text_or_empty(name), 256), 1, 32))


def anchor_rows(docs: DataFrame, text: str, length: int, gram: int) -> DataFrame:
    """(h, dk, a, l, r); h is null for starts l..r already known to repeat."""
    ship_package(docs.sparkSession)

    def run(batches):
        for b in batches:
            data, off = bytes_of(b.column(1))
            keys, hold, size = b.column(0).to_pylist(), [], 0
            for i in range(b.num_rows):
                doc = data[off[i]:off[i + 1]]
                for lo in range(0, max(1, len(doc) - length + 1), CHUNK):
                    h, a, l, r, (s, e) = anchors_of(doc[lo:lo + CHUNK + length - 1], length, gram)
                    if len(h):
                        hold.append((i, np.zeros(len(h), bool), h, a + lo, l + lo, r + lo))
                    if len(s):
                        hold.append((i, np.ones(len(s), bool), np.zeros(len(s), np.int64), s + lo, s + lo, e + lo))
                    size += len(h)
                if size > 50_000 or i == b.num_rows - 1 and hold:
                    who = np.repeat([x[0] for x in hold], [len(x[1]) for x in hold])
                    cols = [np.concatenate(x) for x in list(zip(*hold, strict=True))[1:]]
                    yield pa.record_batch([pa.array(cols[1], pa.int64(), mask=cols[0]), b.column(0).take(pa.array(who)),
                                           *[pa.array(x.astype(np.int64)) for x in cols[2:]]], names=["h", "dk", "a", "l", "r"])
                    hold, size = [], 0

    rows = docs.select(text_key(text).alias("dk"), text_or_empty(text).alias("text")).where(F.octet_length("text") >= length)
    return rows.mapInArrow(run, "h long, dk binary, a long, l long, r long")


def packed_texts(docs: DataFrame, text: str, length: int) -> DataFrame:
    """(dk, z): the compressed texts; of a task's copies of a text only one leaves it."""
    ship_package(docs.sparkSession)

    def run(batches):
        met: set[bytes] = set()  # keys this task has sent on
        for b in batches:
            new = []
            for i, k in enumerate(b.column(0).to_pylist()):
                if k not in met:
                    if len(met) >= 500_000:
                        met.clear()
                    met.add(k)
                    new.append(i)
            for lo in range(0, len(new), 256):
                part = b.take(pa.array(new[lo:lo + 256], pa.int64()))
                yield pa.record_batch([part.column(0), pa.array([zlib.compress(x.as_buffer(), 1) for x in part.column(1)], pa.binary())], names=["dk", "z"])

    rows = docs.select(text_key(text).alias("dk"), text_or_empty(text).alias("text")).where(F.octet_length("text") >= length)
    return rows.mapInArrow(run, "dk binary, z binary")


def suffix_rows(cand: DataFrame, length: int) -> DataFrame:
    """(lead, dk, l, al, nr, unit): an anchor's suffix begins ``al`` bytes into ``unit``, which holds its starts l..l+nr whole."""

    def run(batches):
        for b in batches:
            out, size = [], 0
            for dk, z, found in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist(), strict=True):
                text = zlib.decompress(z.as_buffer())
                for x in found:
                    a, l, r = x["a"], x["l"], x["r"]
                    out.append((text[a:a + LEAD], dk, l, a - l, r - l, text[l:r + length]))
                    size += r - l + length
                if size > 4 << 20:
                    yield pack(out)
                    out, size = [], 0
            if out:
                yield pack(out)

    def pack(out):
        kinds = (pa.binary(), pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
        return pa.record_batch([pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)], names=["lead", "dk", "l", "al", "nr", "unit"])

    return cand.select("dk", "z", "anchors").mapInArrow(run, "lead binary, dk binary, l long, al int, nr int, unit binary")


def multikey_order(rows: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, common prefix with the one before) of zero-padded byte rows, by quicksort on 8-byte tokens.

    Rows are split by their first token; only rows that share it are sorted by the next, and so on."""
    n, width = rows.shape
    pad = -width % 8
    tokens = np.ascontiguousarray(np.pad(rows, ((0, 0), (0, pad)))).view(">u8").astype(np.uint64)
    order, group = np.arange(n), np.zeros(n, np.int64)
    live = np.arange(n)  # places whose order is still open
    for t in range(tokens.shape[1]):
        tok = tokens[order[live], t]
        by = np.lexsort((tok, group[live]))
        order[live] = order[live][by]
        tok, grp = tok[by], group[live]  # places of a group are contiguous, so grp is unchanged by sorting inside it
        new = np.concatenate([[True], (tok[1:] != tok[:-1]) | (grp[1:] != grp[:-1])]) if len(tok) else np.zeros(0, bool)
        group[live] = live[np.flatnonzero(new)][np.cumsum(new) - 1] if len(live) else group[live]
        alone = new & np.concatenate([new[1:], [True]]) if len(new) else new
        live = live[~alone]
        if not len(live):
            break
    if len(live):  # equal but for the padding: the shorter comes first
        by = np.lexsort((lengths[order[live]], group[live]))
        order[live] = order[live][by]
    common = np.zeros(n, np.int64)
    for lo in range(1, n, 4096):
        hi = min(n, lo + 4096)
        x, y = order[lo - 1:hi - 1], order[lo:hi]
        differ = rows[x] != rows[y]
        first = np.where(differ.any(1), differ.argmax(1), width)
        common[lo:hi] = np.minimum(first, np.minimum(lengths[x], lengths[y]))
    return order, common


def repeated_starts(units: list[bytes], al: np.ndarray, nr: np.ndarray, length: int, gram: int) -> np.ndarray:
    """marks[i, s]: start s of unit i is equal to a start of another unit here."""
    n = len(units)
    size = np.fromiter(map(len, units), np.int64, n)
    wide = int(nr.max()) + 1
    right, left = np.zeros((n, length), np.uint8), np.zeros((n, max(1, int(al.max()))), np.uint8)
    for i, u in enumerate(units):
        raw = np.frombuffer(u, np.uint8)
        part = raw[al[i]:al[i] + length]
        right[i, :len(part)] = part
        left[i, :al[i]] = raw[:al[i]][::-1]
    r_order, r_common = multikey_order(right, size - al)
    l_order, l_common = multikey_order(left, al)
    marks = np.zeros((n, wide), bool)
    place = np.empty(n, np.int64)
    place[r_order] = np.arange(n)
    grams = np.cumsum(r_common < gram)[place]
    busy = np.bincount(grams)[grams] > 1  # a gram of its own has no partner
    l_place = np.empty(n, np.int64)
    l_place[l_order] = np.arange(n)
    for d in range(int(al.max()) + 1):  # starts d bytes left of the anchor
        own = np.flatnonzero(busy & (al >= d) & (al - d <= nr))
        if len(own) < 2:
            continue
        key = np.cumsum(r_common < length - d)[place[own]] * n + np.cumsum(l_common < d)[l_place[own]]
        by = np.argsort(key, kind="stable")
        same = key[by][1:] == key[by][:-1]
        hit = np.zeros(len(own), bool)
        hit[by[1:][same]] = True
        hit[by[:-1][same]] = True
        marks[own[hit], al[own[hit]] - d] = True
    return marks


def resolved(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """Sorted buckets -> (dk, s, e): starts s..e repeat."""
    chunk = BUCKET_ROWS // 4

    def flush(t: pa.Table):
        if t.num_rows > 1:
            dk, l, nr = t["dk"].combine_chunks(), np.array(t["l"]), np.array(t["nr"], np.int64)
            m = repeated_starts(t["unit"].to_pylist(), np.array(t["al"], np.int64), nr, length, gram)
            edge = np.diff(np.pad(m, ((0, 0), (1, 1))).astype(np.int8), axis=1)
            who, s = np.nonzero(edge == 1)
            _, e = np.nonzero(edge == -1)
            if len(who):
                yield pa.record_batch([dk.take(pa.array(who)), pa.array(l[who] + s), pa.array(l[who] + e - 1)], names=["dk", "s", "e"])

    def run(batches):
        hold: list[pa.Table] = []
        for b in batches:
            t = pa.Table.from_batches([b])
            lead = np.array(t["lead"].to_pylist(), object)
            new = np.flatnonzero(lead[1:] != lead[:-1]) + 1 if len(lead) else []
            new = [0, *new] if hold and len(lead) and hold[-1]["lead"][-1].as_py() != lead[0] else list(new)
            at = 0
            for x in new:  # a chunk ends where the leading bytes change
                if sum(map(len, hold)) + x - at >= chunk:
                    hold.append(t.slice(at, x - at))
                    yield from flush(pa.concat_tables(hold))
                    hold, at = [], x
            hold.append(t.slice(at))
        if hold:
            yield from flush(pa.concat_tables(hold))

    return rows.mapInArrow(run, "dk binary, s long, e long")


def dealt(suffixes: DataFrame, bucket_rows: int) -> tuple[DataFrame, DataFrame]:
    """(suffixes range-partitioned by their leading bytes and sorted by them; those whose lead more than ``bucket_rows`` have)."""
    per = written(suffixes.groupBy("lead").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bucket_rows).select("lead"), "suffix-hot")
    buckets = max(1, -(-suffixes.count() // bucket_rows))
    cold = suffixes.join(per, "lead", "left_anti").repartitionByRange(buckets, "lead").sortWithinPartitions("lead")
    return cold, suffixes.join(per, "lead", "left_semi")


def across(open_: DataFrame, length: int) -> DataFrame:
    """(dk, s, e) of the starts of the suffixes' units whose string occurs at another start of one."""

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 64):
                part = b.slice(lo, 64)
                out = []
                for i, (s, u) in enumerate(zip(part.column(1).to_pylist(), part.column(3), strict=True)):
                    raw = np.frombuffer(u.as_buffer(), np.uint8)
                    at = np.arange(len(raw) - length + 1)
                    one = spans_hash(prefix_hashes(raw), at, at + length)
                    two = spans_hash(prefix_hashes(mixed(raw.astype(np.uint64) + np.uint64(7))), at, at + length)
                    out.append((np.full(len(at), i), at + s, mixed(one).view(np.int64), mixed(two).view(np.int64)))
                who, p, one, two = (np.concatenate(x) for x in zip(*out, strict=True))
                yield pa.record_batch([part.column(0).take(pa.array(who)), pa.array(p), pa.array(one), pa.array(two)], names=["dk", "p", "f1", "f2"])

    starts = open_.select("dk", F.col("l").alias("s"), F.lit(0).alias("e"), "unit").mapInArrow(run, "dk binary, p long, f1 long, f2 long")
    x = F.xxhash64("dk", "p")
    twice = written(starts.groupBy("f1", "f2").agg(F.min(x).alias("lo"), F.max(x).alias("hi")).where("lo <> hi").select("f1", "f2"), "suffix-twice")
    return starts.join(twice.hint("merge"), ["f1", "f2"]).select("dk", F.col("p").alias("s"), F.col("p").alias("e"))


def repeat_spans(docs: DataFrame, text: str = "text", length: int = LENGTH, gram: int = GRAM, bucket_rows: int = BUCKET_ROWS) -> tuple[DataFrame, DataFrame]:
    """((dk, z): compressed texts that may hold repeats; (dk, s, e): starts s..e repeat), for texts that are distinct."""
    spark = docs.sparkSession
    anchors = written(anchor_rows(docs, text, length, gram), "suffix-anchors")
    x = F.xxhash64("dk", "a")
    grams = anchors.where(F.isnotnull("h")).groupBy("h").agg(F.min(x).alias("lo"), F.max(x).alias("hi")).where("lo <> hi").select("h")
    grams = written(grams, "suffix-grams")
    live = anchors.where(F.isnotnull("h")).join(grams.hint("merge"), "h").select("dk", "a", "l", "r").distinct()
    periodic = anchors.where(F.isnull("h")).select("dk", F.col("l").alias("s"), F.col("r").alias("e"))
    per = live.select("dk", F.struct("a", "l", "r").alias("x")).unionByName(
        periodic.select("dk", F.lit(None).cast("struct<a:long,l:long,r:long>").alias("x"))).groupBy("dk").agg(F.collect_list("x").alias("anchors"))
    per = written(per, "suffix-per-text")
    cand = packed_texts(docs, text, length).join(per.hint("merge"), "dk").groupBy("dk").agg(F.first("z").alias("z"), F.first("anchors").alias("anchors"))
    cand = written(cand, "suffix-texts", "lz4")
    suffixes = written(suffix_rows(cand, length), "suffix-rows")
    cold, hot = dealt(suffixes, bucket_rows)
    marks = written(resolved(cold, length, gram), "suffix-marks").unionByName(periodic)
    if not hot.isEmpty():
        marks = marks.unionByName(written(across(hot, length), "suffix-across"))
    drop_written(spark, suffixes, per, grams)
    return cand.select("dk", "z"), marks


def without(text: bytes, starts: list[tuple[int, int]], length: int) -> tuple[int, int, bytes]:
    """(bytes removed, maximal runs removed, the rest)."""
    out, at, removed, runs = [], 0, 0, 0
    for s, e in sorted(starts):
        s, e = max(s, 0), e + length
        if e <= at and runs:
            continue
        if s > at or not runs:
            out.append(text[at:s])
            runs += 1
            removed += e - s
        else:
            removed += e - at
        at = e
    return removed, runs, b"".join([*out, text[at:]])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM,
                   bucket_rows: int = BUCKET_ROWS, with_text: bool = False) -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans, kept_sha256 (and ``kept``, the remaining bytes, null if unchanged)."""
    ship_package(docs.sparkSession)
    rows = written(docs.select(col(id_col).alias("id"), text_key(text).alias("dk"), F.octet_length(text_or_empty(text)).cast("long").alias("n_bytes"),
                               F.sha2(text_or_empty(text), 256).alias("sha")), "suffix-docs")
    copies = written(rows.groupBy("dk").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1"), "suffix-copies")
    cand, marks = repeat_spans(docs, text, length, gram, bucket_rows)
    spans = marks.distinct().groupBy("dk").agg(F.collect_list(F.struct("s", "e")).alias("spans"))

    def run(batches):
        for b in batches:
            got = []
            for z, spans in zip(b.column(1), b.column(2).to_pylist(), strict=True):
                n, runs, rest = without(zlib.decompress(z.as_buffer()), [(x["s"], x["e"]) for x in spans], length)
                got.append((n, runs, hashlib.sha256(rest).hexdigest(), rest if with_text else None))
            n, runs, sha, rest = zip(*got, strict=True) if got else ((), (), (), ())
            yield pa.record_batch([b.column(0), pa.array(n, pa.int64()), pa.array(runs, pa.int64()), pa.array(sha, pa.string()), pa.array(rest, pa.binary())],
                                  names=["dk", "n", "runs", "cut_sha", "rest"])

    cut = cand.join(spans.hint("merge"), "dk").select("dk", "z", "spans").mapInArrow(run, "dk binary, n long, runs long, cut_sha string, rest binary")
    cut = written(cut, "suffix-cut")
    j = rows.join(copies.hint("merge"), "dk", "left").join(cut.hint("merge"), "dk", "left")
    whole = F.isnotnull("copies") & (F.col("n_bytes") >= length)
    zero = F.lit(0).cast("long")
    pick = lambda a, b, c: F.when(whole, a).otherwise(F.coalesce(b, c))
    out = [F.col("id").alias(id_col), "n_bytes", pick(F.col("n_bytes"), F.col("n"), zero).alias("n_removed"),
           pick(F.lit(1).cast("long"), F.col("runs"), zero).alias("n_spans"), pick(F.lit(hashlib.sha256(b"").hexdigest()), F.col("cut_sha"), F.col("sha")).alias("kept_sha256")]
    return j.select(*out, *([F.when(whole, F.lit(b"")).otherwise(F.col("rest")).alias("kept")] if with_text else []))
