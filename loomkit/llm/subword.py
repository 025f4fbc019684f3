"""SentencePiece segmentation sampling: Gumbel top-k without replacement.

A text's segmentations are the paths of its piece lattice.  With a score for each
piece, a path's log-probability is the sum of its scores less the lattice's
log-partition.  Adding an independent Gumbel variate to every path and taking the
``k`` largest gives ``k`` distinct segmentations sampled without replacement.

The perturbed A-star search never enumerates paths.  A search node is a set of
paths: a common prefix, the pieces excluded at the next step, and everything
after.  A node's largest perturbed value is a Gumbel around the set's total
log-probability (truncated at its parent's value), and the path attaining it is
an ordinary forward draw.  Taking the best node off the heap emits that path and
splits the rest of its set, by the first step where a path differs, into disjoint
nodes.  Only the best nodes still needed are kept.

No piece has white space after another character, so the lattice falls apart at
word starts; the backward sums of each distinct word are computed once a worker.

Piece scores: the vocabulary file is a merge-rank BPE model whose scores are the
negative ranks.  A piece of rank r has weight 1 / (r + ``SHIFT``), raised to
``ALPHA`` (Zipf's law as a unigram stand-in; nothing is trained here).
Characters outside the vocabulary have one reading, their byte pieces.

``inclusion`` is the probability that a segmentation is among the sample given
the (k+1)-th largest perturbed value t: 1 - exp(-exp(log_prob - t)); it is 1
when the text has no more than k segmentations.  The random numbers of a row
depend only on its key, its text and the seed.

Defined results: null text gives no sample; empty text gives one empty
segmentation; equal rows give equal samples; a text with fewer segmentations than
k gives all of them.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomkit.session import ship_package

from .common import col

K = 4
SHIFT = 10.0
ALPHA = 1.0
MEMORY = 200_000  # distinct words remembered per worker
_WORD = re.compile("▁+[^▁]*|[^▁]+")


class Lattices:
    """Piece lattices of words, with the chance of each next piece at each place."""

    def __init__(self, model_file: str, alpha: float = ALPHA):
        import sentencepiece
        self.sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n, sp = self.sp.get_piece_size(), self.sp
        self.pieces = {sp.id_to_piece(i): (i, (SHIFT - sp.get_score(i)) ** -alpha) for i in range(n)
                       if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))}
        self.longest = max(map(len, self.pieces))
        self.byte = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.rare = (SHIFT + n) ** -alpha
        if any(re.search("[^▁]▁", p) for p in self.pieces):
            raise ValueError("the model has pieces across word starts; cutting at words would lose paths")
        self.words: dict[str, list] = {}

    def word(self, w: str) -> list:
        """For each place: (ids, next places, chances) of the pieces that start there."""
        if (known := self.words.get(w)) is not None:
            return known
        n, get, longest = len(w), self.pieces.get, self.longest
        beta, steps = [0.0] * n + [1.0], [None] * n  # backward sums, scaled so that long words don't underflow
        for i in range(n - 1, -1, -1):
            ids, nexts, sums = [], [], []
            for j in range(i + 1, min(n, i + longest) + 1):
                if (p := get(w[i:j])) is not None:
                    ids.append(p[0])
                    nexts.append(j)
                    sums.append(p[1] * beta[j])
            if not nexts or nexts[0] != i + 1:  # the character itself is no piece: its bytes
                raw = w[i].encode("utf-8", "replace")
                ids.insert(0, tuple(self.byte[x] for x in raw))
                nexts.insert(0, i + 1)
                sums.insert(0, self.rare ** len(raw) * beta[i + 1])
            total = sum(sums)
            beta[i] = total
            steps[i] = (ids, nexts, [x / total for x in sums])
            if total < 1e-100:
                for j in range(i, min(n, i + longest) + 1):
                    beta[j] *= 1e100
        if len(self.words) >= MEMORY:
            self.words.clear()
        self.words[w] = steps
        return steps

    def steps_of(self, text: str) -> list:
        """The places of the whole text, word by word."""
        return [self.word(w) for w in _WORD.findall("▁" + text.replace(" ", "▁"))]


def _draw(steps: list, word: int, place: int, rng: np.random.Generator, path: list, chances: list) -> None:
    """Add a forward draw from (word, place) on: the choices as (step, choice, word, place), and their chances."""
    for lo in range(word, len(steps), 64):
        part = steps[lo:lo + 64]
        uniform = iter(rng.random(sum(map(len, part))).tolist())
        for k, places in enumerate(part, lo):
            n = len(places)
            while place < n:
                s = places[place]
                odds = s[2]
                c, u = 0, next(uniform)
                for c, p in enumerate(odds):  # noqa: B007
                    u -= p
                    if u < 0:
                        break
                path.append((s, c, k, place))
                chances.append(odds[c])
                place = s[1][c]
            place = 0


def _truncated(phi: np.ndarray, bound: float, u: np.ndarray) -> np.ndarray:
    """-log(exp(-bound) - log(u) exp(-phi)): Gumbels around ``phi`` given that they are at most ``bound``."""
    if bound == math.inf:
        return phi - np.log(-np.log(u))
    return -np.logaddexp(-bound, np.log(-np.log(u)) - phi)


def sample(lat: Lattices, text: str, k: int, rng: np.random.Generator) -> list[tuple[list[int], float, float, float]]:
    """Up to ``k`` distinct segmentations in order of perturbed value: (ids, log_prob, perturbed, inclusion)."""
    steps = lat.steps_of(text) if text else []
    first = float(_truncated(np.zeros(1), math.inf, rng.uniform(1e-300, 1, 1))[0])
    if not steps:
        return [([], 0.0, first, 1.0)]
    # node: (-value, tie, the path it was split from and its chances, length of the common prefix, excluded choices)
    heap: list = [(-first, 0, [], [], 0, frozenset())]
    out, ties = [], 0
    while heap and len(out) <= k:
        value, _, parent, parent_chances, lo, excluded = heapq.heappop(heap)
        value, path, chances = -value, parent[:lo], parent_chances[:lo]
        if excluded:  # the first step avoids the excluded pieces
            s, _, word, place = parent[lo]
            free = [c for c in range(len(s[2])) if c not in excluded]
            u, c = float(rng.random()) * sum(s[2][c] for c in free), free[-1]
            for x in free:
                u -= s[2][x]
                if u < 0:
                    c = x
                    break
            path.append((s, c, word, place))
            chances.append(s[2][c])
            nxt = s[1][c]
            over = nxt == len(steps[word])
            _draw(steps, word + over, 0 if over else nxt, rng, path, chances)
        else:
            _draw(steps, 0, 0, rng, path, chances)
        each = np.array(chances)
        cum = np.cumsum(np.log(each))
        out.append((path, float(cum[-1]), value))
        if len(out) > k:
            break
        # split what is left of the node's set by the first step that differs from the path
        gone = each[lo:].copy()
        many = np.fromiter((len(e[0][2]) for e in path[lo:]), np.int64, len(path) - lo)
        used = np.ones(len(many), np.int64)
        if excluded:
            gone[0] += sum(path[lo][0][2][c] for c in excluded)
            used[0] += len(excluded)
        at = np.flatnonzero(many > used)
        if not len(at):
            continue
        before = cum[lo + at - 1] if lo else np.concatenate([[0.0], cum])[at]
        values = _truncated(before + np.log(np.maximum(1.0 - gone[at], 1e-300)), value, rng.uniform(1e-300, 1, len(at)))
        need = k + 1 - len(out)
        best = np.argpartition(-values, need - 1)[:need] if len(values) > need else np.arange(len(values))
        for b in best.tolist():
            i = lo + int(at[b])
            ties += 1
            heapq.heappush(heap, (-float(values[b]), ties, path, chances, i, (excluded if i == lo else frozenset()) | {path[i][1]}))
    limit = out[k][2] if len(out) > k else -math.inf
    result = []
    for path, log_prob, value in out[:k]:
        ids: list[int] = []
        for s, c, _, _ in path:
            x = s[0][c]
            ids.extend(x) if isinstance(x, tuple) else ids.append(x)
        inclusion = 1.0 if limit == -math.inf else -math.expm1(-math.exp(min(log_prob - limit, 700.0)))
        result.append((ids, log_prob, value, inclusion))
    return result


_KNOWN: dict[tuple, Lattices] = {}


def lattices(model_file: str, alpha: float = ALPHA) -> Lattices:
    if (model_file, alpha) not in _KNOWN:
        _KNOWN[model_file, alpha] = Lattices(model_file, alpha)
    return _KNOWN[model_file, alpha]


def sample_segmentations(rows: DataFrame, model_file: str, keys: list[str], text: str = "text", k: int = K, alpha: float = ALPHA,
                         seed: int = 1) -> DataFrame:
    """Per row and sample: the keys, sample_no (from 1), ids, log_prob, perturbed, inclusion."""
    ship_package(rows.sparkSession)
    names = [f"k{i}" for i in range(len(keys))]

    def run(batches):
        lat = lattices(model_file, alpha)
        for b in batches:
            found = []
            for i, (key, t) in enumerate(zip(b.column(len(names)).to_pylist(), b.column(len(names) + 1).to_pylist(), strict=True)):
                h = hashlib.blake2b(f"{seed}\x1f{key}\x1f{t}".encode("utf-8", "replace"), digest_size=16).digest()
                rng = np.random.Generator(np.random.PCG64(int.from_bytes(h, "little")))
                found += [(i, n, *x) for n, x in enumerate(sample(lat, t, k, rng), 1)]
                if len(found) >= 4096:
                    yield pack(b, found)
                    found = []
            if found:
                yield pack(b, found)

    def pack(b, found):
        at, n, ids, lp, g, q = zip(*found, strict=True)
        own = [b.column(i).take(pa.array(at)) for i in range(len(names))]
        return pa.record_batch([*own, pa.array(n, pa.int32()), pa.array(ids, pa.list_(pa.int32())), pa.array(lp), pa.array(g), pa.array(q)],
                               names=[*names, "sample_no", "ids", "log_prob", "perturbed", "inclusion"])

    key = F.concat_ws("\x1f", *[F.coalesce(col(c).cast("string"), F.lit("\x00")) for c in keys])
    src = rows.where(F.isnotnull(col(text))).select(*[col(c).alias(n) for c, n in zip(keys, names, strict=True)], key.alias("key"),
                                                    col(text).cast("string").alias("text"))
    schema = T.StructType([*[T.StructField(n, src.schema[n].dataType) for n in names], T.StructField("sample_no", T.IntegerType()),
                           T.StructField("ids", T.ArrayType(T.IntegerType())), *[T.StructField(n, T.DoubleType()) for n in ("log_prob", "perturbed", "inclusion")]])
    out = src.mapInArrow(run, schema)
    return out.select(*[F.col(n).alias(c) for c, n in zip(keys, names, strict=True)], "sample_no", "ids", "log_prob", "perturbed", "inclusion")


def decode_ids(rows: DataFrame, model_file: str, ids: str = "ids", out: str = "text") -> DataFrame:
    """``rows`` with the decoded text of ``ids`` as column ``out``; null ids decode to null."""
    ship_package(rows.sparkSession)

    @F.pandas_udf("string")
    def decode(s: pd.Series) -> pd.Series:
        sp = lattices(model_file).sp
        return pd.Series([None if x is None else sp.decode([int(i) for i in x]) for x in s])

    return rows.withColumn(out, decode(col(ids)))
