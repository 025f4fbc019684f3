"""Image folder edge cases: nested folders, upper-case suffix, root-level
file, undecodable file, alpha channel, non-square size, unlabeled tree."""
import os
import tempfile

import numpy as np
import pytest

from loomkit.sources import images as IM


def _tree():
    root = tempfile.mkdtemp(prefix="lk-img-")
    os.makedirs(f"{root}/cat/nested")
    os.makedirs(f"{root}/dog")
    rgba = np.zeros((4, 6, 4), np.uint8)
    rgba[..., 0], rgba[..., 1], rgba[..., 2], rgba[..., 3] = 200, 100, 50, 128
    with open(f"{root}/cat/a.png", "wb") as f:
        f.write(IM.png_bytes(rgba))                                     # alpha + non-square
    with open(f"{root}/cat/nested/b.PNG", "wb") as f:
        f.write(IM.png_bytes(np.full((8, 8), 77, np.uint8)))            # nested, upper-case suffix
    with open(f"{root}/dog/c.png", "wb") as f:
        f.write(b"not an image")                                        # undecodable
    with open(f"{root}/dog/notes.txt", "w") as f:
        f.write("x")
    with open(f"{root}/root.png", "wb") as f:
        f.write(IM.png_bytes(np.zeros((2, 2), np.uint8)))               # root level: ignored
    return root


def test_manifest_and_decode(spark):
    root = _tree()
    m = IM.image_manifest_dir(spark, root)
    got = sorted((r["label"], os.path.basename(r["image_path"])) for r in m.collect())
    assert got == [("cat", "a.png"), ("cat", "b.PNG"), ("dog", "c.png")]
    d = {os.path.basename(r["image_path"]): r for r in IM.image_decode_resize(spark, root, 3, 5, manifest=m).collect()}
    assert set(d) == {"a.png", "b.PNG", "c.png"}
    a = np.frombuffer(d["a.png"]["data"], np.uint8).reshape(3, 5, 3)
    assert (a[..., 0] == 200).all() and (a[..., 1] == 100).all() and (a[..., 2] == 50).all()   # RGB order, alpha dropped
    assert (np.frombuffer(d["b.PNG"]["data"], np.uint8) == 77).all()
    assert d["c.png"]["decoded"] == 0 and not any(d["c.png"]["data"])
    assert all(len(r["data"]) == 3 * 5 * 3 for r in d.values())


def test_unlabeled_and_missing(spark):
    root = tempfile.mkdtemp(prefix="lk-flat-")
    for i in range(3):
        with open(f"{root}/{i}.jpg" if i else f"{root}/{i}.png", "wb") as f:
            f.write(IM.png_bytes(np.zeros((2, 2), np.uint8)))
    m = IM.image_manifest_dir(spark, root)
    assert m.columns == ["image_path"] and m.count() == 3
    man = spark.createDataFrame([(f"{root}/0.png", "a"), (f"{root}/zz.png", "b")], "image_path string, label string")
    miss = IM.manifest_missing_files(spark, man, root).collect()
    assert [r["image_path"] for r in miss] == [f"{root}/zz.png"]


def test_empty_tree_is_an_error(spark):
    root = tempfile.mkdtemp(prefix="lk-empty-")
    with open(f"{root}/a.txt", "w") as f:
        f.write("x")
    with pytest.raises(ValueError, match="No images"):
        IM.image_manifest_dir(spark, root)


def test_names_that_spark_skips_are_listed_and_decoded(spark):
    root = tempfile.mkdtemp(prefix="lk-odd-")
    for rel, v in [("cats/a.png", 10), ("cats/_b.png", 20), ("_dogs/c.png", 30), ("_dogs/.d.png", 40)]:
        os.makedirs(os.path.dirname(f"{root}/{rel}"), exist_ok=True)
        with open(f"{root}/{rel}", "wb") as f:
            f.write(IM.png_bytes(np.full((2, 2), v, np.uint8)))
    m = IM.image_manifest_dir(spark, root)
    assert sorted((r["label"], os.path.basename(r["image_path"])) for r in m.collect()) == [
        ("_dogs", ".d.png"), ("_dogs", "c.png"), ("cats", "_b.png"), ("cats", "a.png")]
    got = {os.path.basename(r["image_path"]): r["data"][0] for r in IM.image_decode_resize(spark, root, 2, 2, manifest=m).collect()}
    assert got == {"a.png": 10, "_b.png": 20, "c.png": 30, ".d.png": 40}


def test_a_faulty_transform_is_not_hidden(spark):
    root = _tree()

    def broken(a):
        raise RuntimeError("user code failed")

    with pytest.raises(Exception, match="user code failed"):
        IM.image_decode_resize(spark, root, 3, 5, transform=broken).collect()


def test_resize_down_uses_every_pixel_and_up_interpolates():
    img = np.zeros((1, 8, 3), np.uint8)
    img[0, 3] = 200  # a thin line survives a four-fold reduction
    assert IM._resize(img, 1, 2)[0, 0, 0] > 0
    flat = np.full((5, 7, 3), 90, np.uint8)
    assert (IM._resize(flat, 3, 2) == 90).all() and (IM._resize(flat, 11, 13) == 90).all()
    two = np.array([[[0] * 3, [100] * 3]], np.uint8)
    assert IM._resize(two, 1, 4)[0, :, 0].tolist() == [0, 25, 75, 100]
