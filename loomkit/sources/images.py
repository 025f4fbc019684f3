"""Image folders.

* Folders are listed in tasks through ``pyarrow.fs``, one level of the tree
  after another: the folders found on a level are dealt out over the cluster and listed
  for the next, so a tree is listed once and a deep class folder by many tasks.  Names that
  start with ``_`` or ``.`` count like any other (Spark's file sources skip
  them).  Labels come from the path.
* Decoding uses Spark's ``image`` source (undecodable files kept, marked
  with height -1); files it would skip by name are first copied to visible
  names in the checkpoint folder.  Converting to RGB, resizing and an
  optional user transform run per Arrow batch in ``mapInPandas`` with numpy.
"""

from __future__ import annotations

import struct
import zlib
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, StringType, StructField, StructType

from ..functions.storage import arrow_fs

# Image file suffixes (matched case-insensitively).
IMAGE_SUFFIXES = ("jpg", "jpeg", "png", "bmp", "tiff")
_SCHEME = r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?"


def _qualify(spark: SparkSession, path: str) -> str:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).makeQualified(p).toString().rstrip("/")


def _exists(spark: SparkSession, root: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def path_key(c) -> "F.Column":
    """A path without scheme and authority, for matching listings to manifests."""
    return F.regexp_replace(c, _SCHEME, "")


_LISTED = "path string, length long, is_dir boolean"


def _listed(folders: DataFrame) -> DataFrame:
    """The entries of each folder in ``path``, listed where the row is."""
    from ..session import ship_package
    ship_package(folders.sparkSession)

    def run(batches):
        import pyarrow.fs as pafs
        for pdf in batches:
            for folder in pdf["path"]:
                fs, base = arrow_fs(folder)
                found = fs.get_file_info(pafs.FileSelector(base))
                for lo in range(0, len(found), 10_000):
                    part = found[lo:lo + 10_000]
                    yield pd.DataFrame({"path": [folder + f.path[len(base.rstrip("/")):] for f in part],
                                        "length": [f.size or 0 for f in part],
                                        "is_dir": [f.type == pafs.FileType.Directory for f in part]})

    return folders.mapInPandas(run, _LISTED)


def _levels(spark: SparkSession, root: str) -> list[DataFrame]:
    """The entries of each level of the tree, written: one listing a folder."""
    from ..session import materialize
    folders, levels = spark.createDataFrame([(_qualify(spark, root),)], "path string"), []
    while not levels or folders.take(1):
        levels.append(materialize(_listed(folders), "image-listing"))
        folders = levels[-1].where("is_dir").select("path").repartition(spark.sparkContext.defaultParallelism)
    return levels


def _files(levels: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [x.where("not is_dir").select("path", "length") for x in levels])


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """All files under ``root`` (recursive): ``path, length``."""
    return _files(_levels(spark, root))


def _suffix_ok(path_col):
    suf = F.lower(F.regexp_extract(path_col, r"\.([^./]+)$", 1))
    return suf.isin(list(IMAGE_SUFFIXES))


def image_manifest_dir(spark: SparkSession, root: str) -> DataFrame:
    """``(image_path, label)`` when the root has class folders (label =
    first-level folder, files found recursively, root-level files ignored),
    else ``(image_path)`` of every image under the root."""
    if not _exists(spark, root):
        raise FileNotFoundError(f"no folder {root}")
    levels = _levels(spark, root)
    labeled = len(levels) > 1
    base = _qualify(spark, root)
    files = _files(levels).where(_suffix_ok(F.col("path")))
    rel = F.expr(f"substring(path, {len(base) + 2})")
    if labeled:
        files = files.where(F.instr(rel, "/") > 0).select(
            F.col("path").alias("image_path"), F.substring_index(rel, "/", 1).alias("label"))
    else:
        files = files.select(F.col("path").alias("image_path"))
    if files.isEmpty():
        raise ValueError(f"No images under {root} (suffixes {', '.join(IMAGE_SUFFIXES)})")
    return files


def relative_path(spark: SparkSession, path_col, root: str):
    """The part of a path below ``root`` (scheme-independent)."""
    import re
    base = re.sub(_SCHEME, "", _qualify(spark, root))
    return F.substr(path_key(path_col), F.lit(len(base) + 2))


def image_manifest_csv(spark: SparkSession, csv_path: str, image_column: str = "image_path",
                       target_column: str | None = None) -> DataFrame:
    """A CSV manifest with its image column renamed ``image_path`` and
    the target ``label``; a missing image column is an error."""
    df = spark.read.option("header", "true").csv(csv_path)
    if image_column not in df.columns:
        raise ValueError(f"the manifest has no column {image_column!r}, only {df.columns}")
    df = df.withColumnRenamed(image_column, "image_path")
    if target_column and target_column in df.columns:
        df = df.withColumnRenamed(target_column, "label")
    return df


def manifest_missing_files(spark: SparkSession, manifest: DataFrame, root: str) -> DataFrame:
    """Manifest rows naming a file that does not exist under ``root``
    (left anti join with the listing; the manifest itself is kept)."""
    listing = list_files(spark, root).select(path_key(F.col("path")).alias("_k"))
    m = manifest.withColumn("_k", path_key(F.col("image_path")))
    return m.join(listing, "_k", "left_anti").drop("_k")


# ---------------------------------------------------------------- S10
def _weights(n_in: int, n_out: int) -> np.ndarray:
    """(n_out, n_in) weights of a triangle filter, widened when scaling down so that every input pixel counts."""
    scale = n_in / n_out
    reach = max(scale, 1.0)
    centre = (np.arange(n_out) + 0.5) * scale
    w = np.maximum(0.0, 1.0 - np.abs(np.arange(n_in)[None, :] + 0.5 - centre[:, None]) / reach)
    return w / w.sum(axis=1, keepdims=True)


def _resize(img: np.ndarray, h: int, w: int) -> np.ndarray:
    """Anti-aliased bilinear resize, columns then rows, each rounded to uint8 (halves up, whatever the order of the sums)."""
    ih, iw = img.shape[:2]
    f = img.astype("float64")
    if iw != w:
        f = np.floor(np.round(np.einsum("yxc,ox->yoc", f, _weights(iw, w)), 9) + 0.5)
    if ih != h:
        f = np.floor(np.round(np.einsum("yxc,oy->oxc", f, _weights(ih, h)), 9) + 0.5)
    return np.clip(f, 0, 255).astype("uint8")


def to_rgb(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """Spark image bytes (row-major, BGR / BGRA / gray) -> RGB uint8 array."""
    a = np.frombuffer(data, dtype=np.uint8).reshape(height, width, channels)
    if channels == 1:
        return np.repeat(a, 3, axis=2)
    return a[:, :, 2::-1].copy() if channels >= 3 else np.repeat(a[:, :, :1], 3, axis=2)


def _decoded(spark: SparkSession, root: str) -> DataFrame:
    return (spark.read.format("image").option("dropInvalid", "false").option("recursiveFileLookup", "true")
            .load(root).select(F.col("image.origin").alias("image_path"), F.col("image.height").alias("h"),
                               F.col("image.width").alias("w"), F.col("image.nChannels").alias("c"),
                               F.col("image.data").alias("data")))


def _visible_copies(spark: SparkSession, root: str):
    """Files under ``root`` that Spark's sources skip by name, copied to visible
    names: (folder, table of ``_n`` new name and ``image_path``), or None without any."""
    import uuid
    from ..session import materialize, scratch_path, ship_package
    ship_package(spark)
    base = _qualify(spark, root)
    rel = F.expr(f"substring(path, {len(base) + 1})")
    odd = list_files(spark, root).where(rel.rlike("/[_.]"))
    if odd.isEmpty():
        return None
    folder = _qualify(spark, scratch_path(spark, f"visible-images/{uuid.uuid4().hex}"))

    def run(batches):
        import hashlib
        fs, base_out = arrow_fs(folder)
        fs.create_dir(base_out, recursive=True)
        for pdf in batches:
            names = []
            for path in pdf["path"]:
                src, at = arrow_fs(path)
                names.append("f" + hashlib.sha256(path.encode()).hexdigest() + ".img")
                with src.open_input_stream(at) as i, fs.open_output_stream(f"{base_out}/{names[-1]}") as o:
                    while block := i.read(1 << 20):
                        o.write(block)
            yield pd.DataFrame({"_n": names, "image_path": pdf["path"]})

    return folder, materialize(odd.select("path").mapInPandas(run, "_n string, image_path string"), "visible-images")


def image_decode_resize(spark: SparkSession, root: str, height: int, width: int, manifest: DataFrame | None = None,
                        transform=None) -> DataFrame:
    """Decode -> RGB -> resize to (height, width) -> optional
    ``transform(array) -> array`` -> fixed-size uint8 RGB bytes.
    Undecodable files become all-zero images.  With a manifest, only its
    files are kept (join on the path) and its label is carried."""
    imgs = _decoded(spark, root)
    hidden = _visible_copies(spark, root)
    if hidden is not None:
        copies, names = hidden
        again = _decoded(spark, copies).withColumn("_n", F.substring_index("image_path", "/", -1)).drop("image_path")
        imgs = imgs.unionByName(again.join(names, "_n").drop("_n"))
    if manifest is not None:
        m = manifest.select(path_key(F.col("image_path")).alias("_k"),
                            *(["label"] if "label" in manifest.columns else []))
        imgs = imgs.withColumn("_k", path_key(F.col("image_path"))).join(m, "_k").drop("_k")
    keep_label = "label" in imgs.columns
    fields = [StructField("image_path", StringType())]
    if keep_label:
        fields.append(StructField("label", StringType()))
    fields += [StructField("height", IntegerType()), StructField("width", IntegerType()),
               StructField("n_channels", IntegerType()), StructField("data", BinaryType()),
               StructField("decoded", IntegerType())]
    H, W = int(height), int(width)
    from ..session import ship_package
    ship_package(spark)

    def run(batches):
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                ok = int(r.h is not None and r.h > 0 and bool(r.data))
                if ok:  # a fault of the user's transform is the user's to see
                    a = _resize(to_rgb(bytes(r.data), int(r.h), int(r.w), int(r.c)), H, W)
                    if transform is not None:
                        a = np.asarray(transform(a), dtype=np.uint8).reshape(H, W, 3)
                else:
                    a = np.zeros((H, W, 3), dtype=np.uint8)
                row = [r.image_path] + ([r.label] if keep_label else []) + [H, W, 3, a.tobytes(), ok]
                out.append(row)
            yield pd.DataFrame(out, columns=[f.name for f in fields])

    return imgs.mapInPandas(run, StructType(fields))


# ---------------------------------------------------------------- fixtures
def png_bytes(pixels: np.ndarray) -> bytes:
    """Encode a uint8 gray (h, w) or RGB / RGBA (h, w, c) array as PNG."""
    a = np.asarray(pixels, dtype=np.uint8)
    if a.ndim == 2:
        a = a[:, :, None]
    h, w, c = a.shape
    ctype = {1: 0, 3: 2, 4: 6}[c]
    raw = b"".join(b"\x00" + a[y].tobytes() for y in range(h))

    def chunk(tag, data):
        return struct.pack(">I", len(data)) + tag + data + struct.pack(">I", zlib.crc32(tag + data) & 0xFFFFFFFF)

    return (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, ctype, 0, 0, 0))
            + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def quantize_embedding(vec) -> np.ndarray:
    """Unit-norm vector values in [-1, 1] -> uint8 gray levels."""
    v = np.asarray(vec, dtype=np.float32).astype(np.float64)
    return np.clip(np.floor((v + 1.0) * 127.5 + 0.5), 0, 255).astype(np.uint8)


def write_embedding_images(df: DataFrame, root: str, side: int = 8, mixed: bool = False) -> DataFrame:
    """Render each ``embeddings`` row as a ``side x side`` gray PNG at
    ``<root>/<label>/<vec_id:06d>.png``.  ``mixed``: every third row (by id) is a
    colour image of half the height with the values, then their negatives, then zeros as
    red, green and blue, of the first half of the vector; every seventh is cut off inside its header.  Each task writes its own files
    through ``pyarrow.fs`` (local, object store or HDFS folder; rewriting a
    file on retry is harmless); returns ``(vec_id, label, rel_path)``."""
    from ..session import ship_package
    ship_package(df.sparkSession)

    def run(batches):
        fs, base = arrow_fs(root)
        made = set()
        for pdf in batches:
            rels = []
            for vid, lab, emb in zip(pdf["vec_id"], pdf["label"], pdf["embedding"]):
                rel = f"{int(lab)}/{int(vid):06d}.png"
                folder = f"{base}/{int(lab)}"
                if folder not in made:
                    fs.create_dir(folder, recursive=True)
                    made.add(folder)
                gray = quantize_embedding(emb).reshape(side, side)
                data = png_bytes(gray)
                if mixed and vid % 3 == 0:
                    half = gray[:side // 2]
                    data = png_bytes(np.stack([half, 255 - half, np.zeros_like(half)], axis=2))
                if mixed and vid % 7 == 0:
                    data = data[:20]
                with fs.open_output_stream(f"{base}/{rel}") as f:
                    f.write(data)
                rels.append(rel)
            yield pd.DataFrame({"vec_id": pdf["vec_id"], "label": pdf["label"].astype("int32"), "rel_path": rels})

    return df.select("vec_id", "label", "embedding").mapInPandas(
        run, "vec_id long, label int, rel_path string")
