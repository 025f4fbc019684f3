"""Language identification with a byte convolutional network trained in numpy.

Input windows are ``WINDOW`` bytes of UTF-8, zero-padded.  Filters of several
widths slide over the one-hot bytes (each filter is one weight per byte value
and offset), the maximum over the window is pooled, rectified and fed to a
softmax layer.  A text's class probabilities are the byte-weighted mean over all
its windows, so every byte of every text takes part.

Training uses a bounded sample: ``per_lang`` labelled rows of each language (those
with the smallest hash of id), ``windows_per_doc`` windows of each, spread evenly.

Defined results: null text, or text without a letter (``\\p{L}``), is ``und`` with
score 0; so is every text when no labelled row was found.  Rows with a null id or
label are never trained on.  Repeated rows are predicted each on its own.

With ``noise=True`` the network also learns what is no language: windows whose bytes are
shuffled, and windows drawn from the 64 characters of encoded data (both by a seeded rule, as
many as a language has on average).  ``keep_identified`` rejects texts that it takes for
noise with a score of ``limit`` or more, which lies half-way between the highest such score of
any labelled training window and 1, and not under ``LEAST_LIMIT``.  A text shorter than a window
holds too little to be rejected: a key or a number may be most of it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from loomkit.session import ship_package

from .common import bytes_of, col, text_or_empty, unpack_row, whole_row

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
PER_LANG = 600
WINDOWS_PER_DOC = 4
UND = "und"
LEAST_LIMIT = 0.9


def held_out(id_col: str) -> Column:
    """Rows whose crc32(id as text) mod 4 is 2 are kept away from training."""
    return F.coalesce(F.crc32(col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def windows_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows, row of each window, bytes in each window); empty rows have none."""
    n = np.diff(offsets)
    count = -(-n // WINDOW)
    ends = np.cumsum(count)
    buf = np.zeros(int(ends[-1]) * WINDOW if len(n) else 0, np.uint8)
    for s, e, w in zip(offsets[:-1].tolist(), offsets[1:].tolist(), ((ends - count) * WINDOW).tolist(), strict=True):
        buf[w:w + e - s] = data[s:e]
    row = np.repeat(np.arange(len(n)), count)
    first = np.repeat(ends - count, count)
    left = np.repeat(n, count) - (np.arange(len(row)) - first) * WINDOW
    return buf.reshape(-1, WINDOW), row, np.minimum(left, WINDOW)


class ByteCNN:
    """Weights: ``taps[w][o, byte, filter]``, pooled bias, and the softmax layer."""

    def __init__(self, langs: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.langs = langs
        self.taps = {w: rng.normal(0, 0.3 / w, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS}
        self.bias = np.zeros(FILTERS * len(WIDTHS), np.float32)
        self.out = rng.normal(0, 0.2, (FILTERS * len(WIDTHS), len(langs))).astype(np.float32)
        self.out_bias = np.zeros(len(langs), np.float32)
        self.limit = 1.0

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 6, batch: int = 64, rate: float = 0.01, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        params = [*self.taps.values(), self.bias, self.out, self.out_bias]
        m, v, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
        f = np.arange(FILTERS)
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for lo in range(0, len(x), batch):
                xb, yb = x[order[lo:lo + batch]], y[order[lo:lo + batch]]
                rows, peaks, pooled = np.arange(len(xb)), [], []
                for w in WIDTHS:
                    span = WINDOW - w + 1
                    z = sum(self.taps[w][o][xb[:, o:o + span]] for o in range(w))
                    at = z.argmax(1)
                    peaks.append(at)
                    pooled.append(np.take_along_axis(z, at[:, None, :], 1)[:, 0])
                a = np.concatenate(pooled, 1) + self.bias
                h = np.maximum(a, 0)
                p = _softmax(h @ self.out + self.out_bias)
                p[rows, yb] -= 1
                p /= len(xb)
                da = (p @ self.out.T) * (a > 0)
                grads = []
                for k, w in enumerate(WIDTHS):
                    g = np.zeros_like(self.taps[w])
                    for o in range(w):
                        np.add.at(g[o], (xb[rows[:, None], peaks[k] + o], f[None, :]), da[:, k * FILTERS:(k + 1) * FILTERS])
                    grads.append(g)
                grads += [da.sum(0), h.T @ p, p.sum(0)]
                t += 1
                for i, (w_, g) in enumerate(zip(params, grads, strict=True)):
                    m[i] += 0.1 * (g - m[i])
                    v[i] += 0.001 * (g * g - v[i])
                    w_ -= rate * (m[i] / (1 - 0.9 ** t)) / (np.sqrt(v[i] / (1 - 0.999 ** t)) + 1e-8)

    def tables(self) -> dict:
        """Weights summed up for pairs of neighbouring bytes, for fewer lookups when predicting."""
        pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(65536, FILTERS)
        out = {}
        for w, t in self.taps.items():
            out[w] = [pair(t[o], t[o + 1]) for o in range(0, w - 1, 2)] + ([t[w - 1]] if w % 2 else [])
        return out

    def probabilities(self, x: np.ndarray, tables: dict, step: int = 64) -> np.ndarray:
        out = np.empty((len(x), len(self.langs)), np.float32)
        for lo in range(0, len(x), step):
            xb = x[lo:lo + step]
            pairs = xb[:, :-1].astype(np.int32) * 256 + xb[:, 1:]
            pooled = []
            for w in WIDTHS:
                span, z = WINDOW - w + 1, None
                for k, table in enumerate(tables[w]):
                    at = (pairs if len(table) > 256 else xb)[:, 2 * k:2 * k + span]
                    part = table.take(at, axis=0)
                    z = part if z is None else np.add(z, part, out=z)
                pooled.append(z.max(1))
            out[lo:lo + step] = _softmax(np.maximum(np.concatenate(pooled, 1) + self.bias, 0) @ self.out + self.out_bias)
        return out


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def train(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang", per_lang: int = PER_LANG,
          windows_per_doc: int = WINDOWS_PER_DOC, noise: bool = False) -> ByteCNN:
    """Fit on at most ``per_lang`` rows of each language, none of them held out; ``noise`` adds the class of no language."""
    ship_package(docs.sparkSession)
    rows = docs.select(col(id_col).alias("id"), col(lang).cast("string").alias("lang"), held_out(id_col).alias("held"),
                       col(text).cast("string").alias("text"))
    rows = rows.where(F.isnotnull("id") & F.isnotnull("lang") & ~F.col("held"))
    rank = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    chosen = rows.select("id", "lang").withColumn("k", F.row_number().over(rank)).where(F.col("k") <= per_lang).select("id")

    def sample(batches):
        for b in batches:
            x, row, _ = windows_of(*bytes_of(b.column(1)))
            keep = []
            for r in np.unique(row):
                own = np.flatnonzero(row == r)
                keep += own[np.unique(np.linspace(0, len(own) - 1, windows_per_doc).astype(int))].tolist()
            yield pa.record_batch([b.column(0).take(pa.array(row[keep], pa.int64())), pa.array([x[k].tobytes() for k in keep], pa.binary())],
                                  names=["lang", "bytes"])

    # the chosen ids are bounded by per_lang rows a language
    small = rows.where(F.col("text").rlike(r"\p{L}")).join(F.broadcast(chosen.distinct()), "id", "left_semi").select("lang", "text")
    got = sorted((r.lang, bytes(r.bytes)) for r in small.mapInArrow(sample, "lang string, bytes binary").collect())
    langs = sorted({g[0] for g in got})
    x = np.frombuffer(b"".join(g[1] for g in got), np.uint8).reshape(-1, WINDOW)
    y = np.array([langs.index(g[0]) for g in got], np.int64)
    if noise and langs:
        junk = noise_windows(x, max(2, len(x) // len(langs)))
        model = ByteCNN([*langs, UND])
        model.fit(np.concatenate([x, junk]), np.concatenate([y, np.full(len(junk), len(langs))]))
        highest = float(model.probabilities(x, model.tables())[:, -1].max())
        model.limit = max(LEAST_LIMIT, (1 + highest) / 2)
        return model
    model = ByteCNN(langs)
    if len(langs) > 1:
        model.fit(x, y)
    return model


def noise_windows(x: np.ndarray, n: int, seed: int = 23) -> np.ndarray:
    """``n`` windows of no language: half with the bytes of windows of ``x`` shuffled, half of random base-64 characters."""
    rng = np.random.default_rng(seed)
    out = x[rng.integers(0, len(x), n)].copy()
    for row in out:
        size = np.count_nonzero(row)  # the padding stays
        row[:size] = rng.permutation(row[:size])
    letters = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
    out[n // 2:] = letters[rng.integers(0, 64, (n - n // 2, WINDOW))]
    return out


def _predicted(rows: DataFrame, model: ByteCNN) -> DataFrame:
    """``rows`` (carry, text, letters) -> (carry, lang_pred, score)."""
    ship_package(rows.sparkSession)

    def run(batches):
        tables = model.tables() if model.langs else {}
        for b in batches:
            letters = b.column(2).to_numpy(zero_copy_only=False).astype(bool)
            total = np.zeros((b.num_rows, max(1, len(model.langs))))
            if model.langs:
                data, off = bytes_of(b.column(1))
                for lo in range(0, b.num_rows, 512):  # bounds the padded copy
                    cut = off[lo:lo + 513]
                    x, row, n = windows_of(data[cut[0]:cut[-1]], cut - cut[0])
                    if len(x):
                        np.add.at(total, row + lo, model.probabilities(x, tables) * n[:, None])
                total /= np.maximum(np.diff(off), 1)[:, None]
            best, known = total.argmax(1), letters & bool(model.langs)
            yield pa.record_batch([b.column(0), pa.array([model.langs[k] if ok else UND for k, ok in zip(best, known, strict=True)], pa.string()),
                                   pa.array(np.clip(np.where(known, total.max(1), 0.0), 0, 1))], names=["carry", "lang_pred", "score"])

    schema = T.StructType([T.StructField("carry", rows.schema["carry"].dataType), T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(run, schema)


def _inputs(docs: DataFrame, carry: Column, text: str) -> DataFrame:
    return docs.select(carry.alias("carry"), text_or_empty(text).alias("text"), text_or_empty(text).rlike(r"\p{L}").alias("letters"))


def predict(docs: DataFrame, model: ByteCNN, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, held_out, lang_pred, score."""
    out = _predicted(_inputs(docs, F.struct(col(id_col).alias("id"), held_out(id_col).alias("held")), text), model)
    return out.select(F.col("carry.id").alias(id_col), F.col("carry.held").alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, model: ByteCNN, text: str = "text") -> DataFrame:
    """``docs`` without null and letterless texts, and without what a model trained with ``noise`` takes for noise
    with a score of ``model.limit`` or more and a window's length; columns as they were.

    A model without languages (no labelled row outside the held-out ones) tells nothing about a text:
    then only null and letterless texts go."""
    if not model.langs:
        return docs.where(text_or_empty(text).rlike(r"\p{L}"))
    out = _predicted(_inputs(docs, whole_row(docs), text), model)  # letterless texts score 0
    short = F.octet_length(F.col("carry").getField(text).cast("string")) < WINDOW
    keep = (F.col("lang_pred") != UND) | ((F.col("score") > 0) & (short | (F.col("score") < model.limit)))
    return unpack_row(out.where(keep), "carry", docs.columns)
