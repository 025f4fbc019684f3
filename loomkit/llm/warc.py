"""WARC archives: writing with segments and chunked bodies, reading and reassembling.

Writing: each task writes gzip-per-record archives of bounded size into a folder
all executors share (``pyarrow.fs``), and the manifest of finished archives is a
written table, so a retried task leaves no record twice.  Response blocks are HTTP
messages in chunked transfer coding; a block longer than ``segment`` bytes is
split into a first record and continuation records.

Reading: every archive is streamed record by record.  Segments are grouped by the
identifier of their origin record, put in order of segment number, checked to be
complete and to add up to the total length, and the HTTP body is decoded from its
chunk framing.  Records in one piece skip the shuffle.

Defined results: null html is the empty payload; a null id never is the largest
but may be the only one of its group; rows with the same id and payload are written
alike; a null or odd URL is written percent-encoded or left out.  A record whose
segments are missing, repeated or of the wrong total, or whose framing is broken,
comes back with ``error`` set and no payload.  An empty table makes no archive.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomkit.session import scratch_path, ship_package

from .common import col, written

ARCHIVE_BYTES = 32 << 20
SEGMENT_BYTES = 2048
CHUNK_BYTES = 1024
DATE = "2024-01-01T00:00:00Z"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: the URL name space of RFC 4122
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value of the format

MANIFEST = "path string, records long, bytes long"
SEGMENTS = ("origin string, number int, total long, record_type string, page_id long, url string, digest string, "
            "refers_to long, block binary, whole boolean")
RECORDS = ("record_id string, record_type string, page_id long, url string, declared_digest string, refers_to long, "
           "payload binary, payload_bytes long, payload_digest string, error string")


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def chunked(body: bytes, size: int = CHUNK_BYTES) -> bytes:
    parts = [b"%x\r\n%b\r\n" % (len(p), p) for p in (body[i:i + size] for i in range(0, len(body), size))]
    return b"".join([*parts, b"0\r\n\r\n"])


def dechunked(data: bytes) -> bytes:
    """The body behind chunk framing; chunk extensions and trailers are skipped. Raises ValueError if it is broken."""
    out, at = [], 0
    while True:
        end = data.find(b"\r\n", at)
        if end < 0:
            raise ValueError("chunk size line missing")
        size = int(data[at:end].split(b";", 1)[0].strip() or b"x", 16)
        at = end + 2
        if size == 0:
            return b"".join(out)
        if size < 0 or data[at + size:at + size + 2] != b"\r\n":
            raise ValueError("chunk cut short")
        out.append(data[at:at + size])
        at += size + 2


def body_of(block: bytes) -> bytes:
    """The HTTP message's payload."""
    head, sep, body = block.partition(b"\r\n\r\n")
    if not sep:
        raise ValueError("HTTP header not ended")
    fields = [x.partition(b":") for x in head.split(b"\r\n")[1:]]
    coding = [v.strip().lower() for k, _, v in fields if k.strip().lower() == b"transfer-encoding"]
    return dechunked(body) if coding and coding[-1].endswith(b"chunked") else body


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields)
    raw = b"WARC/1.1\r\n%bContent-Length: %d\r\n\r\n%b\r\n\r\n" % (head.encode(), len(block), block)
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def _records(name: str, page_id, url, payload: bytes, digest: str, refers_to, refers_url, segment: int) -> Iterator[bytes]:
    """The records of one page, each compressed on its own; ``name`` is unique in the run."""
    ident = lambda k: f"<urn:uuid:{uuid.uuid5(_SPACE, f'{name}/{k}')}>"
    safe = lambda u: urllib.parse.quote(u, safe="%/:=&?~#+!$,;'@()*[]")
    common = [("WARC-Date", DATE), *([("WARC-Target-URI", safe(url))] if url else []), ("WARC-Payload-Digest", f"sha1:{digest}"),
              *([("Page-ID", str(page_id))] if page_id is not None else [])]
    if refers_to is not None:
        more = [("WARC-Refers-To-Target-URI", safe(refers_url))] if refers_url else []
        yield _record([("WARC-Type", "revisit"), ("WARC-Record-ID", ident(1)), *common, ("WARC-Profile", _REVISIT), *more,
                       ("Refers-To-Page-ID", str(refers_to)), ("Content-Type", "application/http;msgtype=response")],
                      b"HTTP/1.1 200 OK\r\n\r\n")
        return
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    n = max(1, -(-len(block) // segment))
    for k in range(1, n + 1):
        part = block[(k - 1) * segment:k * segment]
        if k == 1:
            numbered = [("WARC-Segment-Number", "1")] if n > 1 else []
            yield _record([("WARC-Type", "response"), ("WARC-Record-ID", ident(1)), *common, *numbered,
                           ("Content-Type", "application/http;msgtype=response")], part)
        else:
            total = [("WARC-Segment-Total-Length", str(len(block)))] if k == n else []
            yield _record([("WARC-Type", "continuation"), ("WARC-Record-ID", ident(k)), ("WARC-Date", DATE),
                           ("WARC-Segment-Origin-ID", ident(1)), ("WARC-Segment-Number", str(k)), *total], part)


def write_archives(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html", least: int = 0,
                   segment: int = SEGMENT_BYTES, folder: str | None = None) -> DataFrame:
    """Write one record per row and return the manifest of archives.

    Of rows with equal payloads of at least ``least`` bytes, that with the largest
    id is a response and the others are revisits of it."""
    spark = pages.sparkSession
    ship_package(spark)
    folder = folder or scratch_path(spark, f"llm/warc-{uuid.uuid4().hex}")
    p = pages.select(col(id_col).cast("long").alias("id"), col(url).cast("string").alias("url"),
                     F.encode(F.coalesce(col(html).cast("string"), F.lit("")), "UTF-8").alias("payload"))
    p = p.withColumn("key", F.sha1("payload"))
    first = p.where(F.length("payload") >= least).groupBy("key").agg(
        F.max("id").alias("top"), F.max_by("url", "id").alias("top_url"), F.count(F.lit(1)).alias("n"))
    rows = p.join(first.where("n > 1").drop("n"), "key", "left").select(
        "id", "url", "payload", F.when(~F.col("id").eqNullSafe(F.col("top")), F.col("top")).alias("refers"), "top_url")

    def run(batches):
        part, k, out, size, n, path = TaskContext.get().partitionId(), 0, None, 0, 0, ""
        attempt = uuid.uuid4().hex  # a second attempt at this task writes other files; the manifest names the ones that count
        done = []
        for b in batches:
            for r in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if out is None:
                    fs, root = pafs.FileSystem.from_uri(folder)
                    fs.create_dir(root, recursive=True)
                    path = f"{folder}/part-{part:05d}-{k:04d}-{attempt}.warc.gz"
                    out, size, n = fs.open_output_stream(pafs.FileSystem.from_uri(path)[1], compression=None), 0, 0
                page, u, payload, refers, top_url = r
                for rec in _records(f"{path}/{n}", page, u, payload, base32_sha1(payload), refers, top_url, segment):
                    out.write(rec)
                    size += len(rec)
                n += 1
                if size >= ARCHIVE_BYTES:
                    out.close()
                    done.append((path, n, size))
                    out, k = None, k + 1
        if out is not None:
            out.close()
            done.append((path, n, size))
        if done:
            yield pa.record_batch([pa.array(x, t) for x, t in zip(zip(*done, strict=True), (pa.string(), pa.int64(), pa.int64()), strict=True)],
                                  names=["path", "records", "bytes"])

    return written(rows.mapInArrow(run, MANIFEST), "warc-manifest")


def parse(stream) -> Iterator[tuple[dict, bytes]]:
    """(header fields, block) of each record of an uncompressed stream."""
    while True:
        line = stream.readline()
        while line in (b"\r\n", b"\n"):
            line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record at {line[:40]!r}")
        fields = {}
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            k, _, v = line.decode("utf-8", "replace").partition(":")
            fields[k.strip().lower()] = v.strip()
        yield fields, stream.read(int(fields["content-length"]))


def read_segments(manifest: DataFrame) -> DataFrame:
    """One row per record of the archives, continuation records with their origin's identifier."""
    ship_package(manifest.sparkSession)

    def rows_of(path):
        fs, at = pafs.FileSystem.from_uri(path)
        with fs.open_input_stream(at, compression=None) as raw, gzip.GzipFile(fileobj=raw) as z:
            for f, block in parse(z):
                kind = f.get("warc-type", "")
                if kind in ("response", "revisit", "continuation"):
                    num = lambda k, f=f: int(f[k]) if k in f else None
                    number = num("warc-segment-number")
                    yield (f.get("warc-segment-origin-id") or f["warc-record-id"], number or 1, num("warc-segment-total-length"), kind,
                           num("page-id"), f.get("warc-target-uri"), f.get("warc-payload-digest", "").partition(":")[2] or None,
                           num("refers-to-page-id"), block, number is None)

    def run(batches):
        schema = pa.schema([("origin", pa.string()), ("number", pa.int32()), ("total", pa.int64()), ("record_type", pa.string()),
                            ("page_id", pa.int64()), ("url", pa.string()), ("digest", pa.string()), ("refers_to", pa.int64()),
                            ("block", pa.binary()), ("whole", pa.bool_())])
        hold, size = [], 0
        pack = lambda: pa.record_batch([pa.array(x, t.type) for x, t in zip(zip(*hold, strict=True), schema, strict=True)], schema=schema)
        for b in batches:
            for path in b.column(0).to_pylist():
                for row in rows_of(path):
                    hold.append(row)
                    size += len(row[8])
                    if size > 4 << 20:
                        yield pack()
                        hold, size = [], 0
        if hold:
            yield pack()

    n = max(1, manifest.count())  # one archive a task
    return manifest.select("path").repartition(n).mapInArrow(run, SEGMENTS)


_OUT = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("page_id", pa.int64()), ("url", pa.string()),
                  ("declared_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
                  ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("error", pa.string())])


def _finished(segments: list[tuple]) -> tuple:
    """One output row from the segments of one origin, in order of their numbers."""
    first = next((s for s in segments if s[3] != "continuation"), segments[0])
    origin, _, _, kind, page, url, digest, refers = first[:8]
    payload, error = None, None
    if [s[1] for s in segments] != list(range(1, len(segments) + 1)):
        error = "segments missing or repeated"
    elif not first[9]:
        total = segments[-1][2]
        if total is None or total != sum(len(s[8]) for s in segments):
            error = "segments do not add up to the total length"
    if error is None and kind == "response":
        try:
            payload = body_of(b"".join(s[8] for s in segments))
        except ValueError as e:
            error = str(e)
    return (origin, kind, page, url, digest, refers, payload, None if payload is None else len(payload),
            None if payload is None else base32_sha1(payload), error)


def reassemble(segments: DataFrame) -> DataFrame:
    """One row per record: type, ids, payload (null for revisits), its length and digest, and ``error``."""
    ship_package(segments.sparkSession)

    def run(batches):
        hold, out, size = [], [], 0
        pack = lambda: pa.record_batch([pa.array(x, t.type) for x, t in zip(zip(*out, strict=True), _OUT, strict=True)], schema=_OUT)
        for b in batches:
            for row in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if hold and hold[0][0] != row[0]:
                    out.append(_finished(hold))
                    hold = []
                hold.append(row)
                size += len(row[8])
                if size > 4 << 20 and out:
                    yield pack()
                    out, size = [], 0
        if hold:
            out.append(_finished(hold))
        if out:
            yield pack()

    parts = segments.where(~F.col("whole"))
    parts = parts.repartition("origin").sortWithinPartitions("origin", "number")
    return segments.where(F.col("whole")).mapInArrow(run, RECORDS).unionByName(parts.mapInArrow(run, RECORDS))


def round_trip(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html", least: int = 0,
               segment: int = SEGMENT_BYTES) -> DataFrame:
    """Write ``pages``, read the archives back: id, payload_bytes, payload_digest, record_type, refers_to.

    A revisit's length and digest come from the response it refers to."""
    manifest = write_archives(pages, id_col, url, html, least, segment)
    # the archives are streamed once for records in one piece and once for segments: less than writing all blocks again
    got = written(reassemble(read_segments(manifest)).drop("payload"), "warc-records")
    response = got.where(F.col("record_type") == "response")
    target = response.where(F.isnotnull("page_id")).groupBy("page_id", "payload_digest").agg(F.max("payload_bytes").alias("full"))
    revisit = got.where(F.col("record_type") == "revisit").alias("v").join(
        target.alias("t"), (F.col("v.refers_to") == F.col("t.page_id")) & (F.col("v.declared_digest") == F.col("t.payload_digest")), "left")
    names = [id_col, "payload_bytes", "payload_digest", "record_type", "refers_to", "error"]
    one = response.select(F.col("page_id").alias(id_col), *names[1:])
    return one.unionByName(revisit.select(F.col("v.page_id").alias(id_col), F.col("t.full").alias("payload_bytes"), F.col("t.payload_digest").alias("payload_digest"),
                                          F.col("v.record_type").alias("record_type"), F.col("v.refers_to").alias("refers_to"),
                                          F.when(F.isnull("t.full"), F.lit("no such response")).otherwise(F.col("v.error")).alias("error")))
