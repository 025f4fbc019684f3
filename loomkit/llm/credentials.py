"""Secret scan with multipart credential linking.

Strong (base) findings stand alone: assignments, access keys and long hex runs.
Weak parts (user or client identifiers, mixed tokens, service endpoints) prove
nothing alone.  An interval join inside each document pairs them: a part's scope
is its span widened by ``REACH`` code points on both sides, cut at blank lines.
A weak part is reported only when its scope holds the complementary parts: a
weak secret needs an identifier or access key, an identifier or endpoint needs a
secret (weak or strong) in scope; a link carries the nearest part of each other
role.

The join runs in the task that holds the text, as sorted searches over the
spans, so it needs no shuffle and no row is paired with another document's.

Defined results: null or empty text has no span; repeated rows each get their
own result; other columns are untouched.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomkit.session import ship_package

from .common import col, text_or_empty, unpack_row, whole_row

REACH = 200
KINDS = ["assign", "access", "hex", "identifier", "token", "endpoint"]
_ORDER = {k: i for i, k in enumerate(KINDS)}

_WORDS = ("password", "passwd", "secret", "token", "api")
_ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
_IDENT = re.compile(r"""(?ai:\b(?:user(?:_?name)?|login|account(?:_?id)?|client_?id|access_?key(?:_?id)?))["']?\x20*[:=]\x20*["']?"""
                    r"""[A-Za-z0-9@+/_.-]{3,}""")
_TOKEN = re.compile(r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z0-9+/_-]*[0-9])(?=[A-Za-z0-9+/_-]*[A-Z])(?=[A-Za-z0-9+/_-]*[a-z])"
                    r"[A-Za-z0-9+/_-]{16,}={0,2}")
_ENDPOINT = re.compile(r"""(?ai:\b(?:https?|ftp|ssh|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqps?|s3)://[^\s"'<>]+)""")
_BLANK = re.compile(r"\n[ \t\r]*\n")

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Leftmost, non-overlapping matches of each base kind that pass its length rule."""
    out: list[Span] = []
    low = text.lower()
    if any(w in low for w in _WORDS):
        out += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text)]
    out += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return out


def weak_spans(text: str) -> list[Span]:
    out = [("endpoint", m.start(), m.end()) for m in _ENDPOINT.finditer(text)] if "://" in text else []
    out += [("token", m.start(), m.end()) for m in _TOKEN.finditer(text)]
    if "=" in text or ":" in text:
        out += [("identifier", m.start(), m.end()) for m in _IDENT.finditer(text)]
    return out


_ROLE = {"assign": "secret", "hex": "secret", "token": "secret", "access": "id", "identifier": "id", "endpoint": "endpoint"}


def linked(text: str, base: list[Span], weak: list[Span], reach: int = REACH) -> list[tuple[Span, list[Span]]]:
    """Weak spans with the complementary parts in their scope; those without any are left out."""
    taken = sorted((s, e) for _, s, e in base)
    starts = [s for s, _ in taken]

    reached = list(accumulate((e for _, e in taken), max))  # the farthest end of the spans so far

    def free(s: int, e: int) -> bool:  # not inside or across a base span
        i = bisect.bisect_left(starts, e)
        return i == 0 or reached[i - 1] <= s

    weak = [w for w in weak if w[0] != "token" or free(w[1], w[2])]
    inside = sorted((s, e) for k, s, e in weak if k != "token")
    weak = [w for w in weak if w[0] != "token" or not any(s <= w[1] and w[2] <= e for s, e in inside)]
    parts = sorted([*base, *weak], key=lambda x: (x[1], x[2], _ORDER[x[0]]))
    cuts = [m.start() for m in _BLANK.finditer(text)] if parts else []
    section = [bisect.bisect_right(cuts, p[1]) for p in parts]
    by_role = {r: [i for i, p in enumerate(parts) if _ROLE[p[0]] == r] for r in ("secret", "id", "endpoint")}
    at = {r: [parts[i][1] for i in v] for r, v in by_role.items()}
    wide = max([0, *(e - s for _, s, e in parts)])

    def nearest(i: int, role: str) -> Span | None:
        kind, s, e = parts[i]
        lo, hi = bisect.bisect_left(at[role], s - reach - wide), bisect.bisect_right(at[role], e + reach)
        best = None
        for j in by_role[role][lo:hi]:
            k2, s2, e2 = parts[j]
            gap = max(s2 - e, s - e2, 0)
            if j != i and section[j] == section[i] and gap <= reach and (best is None or gap < best[0]):
                best = (gap, parts[j])
        return best and best[1]

    out = []
    for i, p in enumerate(parts):
        if p[0] in ("identifier", "endpoint", "token"):
            need = {"token": ["id"], "identifier": ["secret"], "endpoint": ["secret"]}[p[0]]
            found = [nearest(i, r) for r in need]
            if all(found):
                more = [x for r in ("secret", "id", "endpoint") if r != _ROLE[p[0]] and r not in need and (x := nearest(i, r))]
                out.append((p, [*found, *more]))
    return out


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (x[1], _ORDER[x[0]], x[2])))


def scan_text(text: str, reach: int = REACH) -> dict:
    base = base_spans(text)
    weak = weak_spans(text)
    links = linked(text, base, weak, reach) if weak else []
    n = {k: 0 for k in KINDS}
    for k, _, _ in base:
        n[k] += 1
    return {"n_assign": n["assign"], "n_access": n["access"], "n_hex": n["hex"],
            "base_sha256": hashlib.sha256(joined(base).encode()).hexdigest(),
            "spans": joined([*base, *(w for w, _ in links)]),
            "links": ";".join(f"{k}:{s}:{e}>{joined(f)}" for (k, s, e), f in links)}


_FOUND = T.StructType([T.StructField("n_assign", T.LongType()), T.StructField("n_access", T.LongType()),
                       T.StructField("n_hex", T.LongType()), T.StructField("base_sha256", T.StringType()),
                       T.StructField("spans", T.StringType()), T.StructField("links", T.StringType())])


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text", reach: int = REACH) -> DataFrame:
    """Per row: id, counts of base findings, digest of the base spans, all spans and the links behind weak ones."""
    ship_package(docs.sparkSession)
    names = _FOUND.fieldNames()

    def run(batches):
        for b in batches:
            found = [scan_text(t.as_py(), reach) for t in b.column(1)]
            yield pa.record_batch([b.column(0), *[pa.array([f[x] for f in found], pa.int64() if x[:2] == "n_" else pa.string())
                                                  for x in names]], names=["id", *names])

    rows = docs.select(col(id_col).alias("id"), text_or_empty(text).alias("text"))
    return rows.mapInArrow(run, T.StructType([T.StructField("id", rows.schema["id"].dataType), *_FOUND.fields])
                           ).withColumnRenamed("id", id_col)


def redact_text(text: str, mark: str, reach: int = REACH) -> str:
    base = base_spans(text)
    spans = sorted((s, e) for _, s, e in [*base, *(w for w, _ in linked(text, base, weak_spans(text), reach))])
    out, at = [], 0
    for s, e in spans:  # overlapping spans become one mark
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join([*out, text[at:]]) if spans else text


def redact(docs: DataFrame, text: str = "text", length: str | None = "n_chars", mark: str = "[SECRET]",
           reach: int = REACH) -> DataFrame:
    """``docs`` with every reported span replaced by ``mark`` and ``length`` (code points) brought up to date.

    Rows without a finding, null texts included, stay exactly as they were."""
    ship_package(docs.sparkSession)

    def run(batches):
        for b in batches:
            texts = [t.as_py() for t in b.column(1)]
            new = [None if t is None else redact_text(t, mark, reach) for t in texts]
            changed = [n if n is not None and n != t else None for n, t in zip(new, texts, strict=True)]
            yield pa.record_batch([b.column(0), pa.array(changed, pa.string())], names=["row", "new"])

    rows = docs.select(whole_row(docs).alias("row"), col(text).cast("string").alias("text"))
    out = rows.mapInArrow(run, T.StructType([T.StructField("row", rows.schema["row"].dataType), T.StructField("new", T.StringType())]))

    def value(c: str):
        if c == text:
            return F.coalesce("new", F.col("row").getField(c)).alias(c)
        if c == length:
            kind = docs.schema[c].dataType
            return F.when(F.isnotnull("new"), F.char_length("new").cast(kind)).otherwise(F.col("row").getField(c)).alias(c)
        return F.col("row").getField(c).alias(c)

    return out.select(*[value(c) for c in docs.columns])
