"""Image path on generated PNGs: channel order, resize, grey/alpha, path
identity, glob vs suffix filter, rejects, recursion, labelled folders."""

import os

import numpy as np
from pyspark.sql import functions as F

from lookout.functions.images import augment_vector, resize_bilinear, to_pixel_vector
from lookout.sources import images as I
from tests import pngs


def numpy_bilinear(img, oh, ow):
    """Independent half-pixel-centre bilinear resize (loops, for the test)."""
    h, w, c = img.shape
    out = np.zeros((oh, ow, c))
    for i in range(oh):
        y = min(max((i + 0.5) * h / oh - 0.5, 0), h - 1)
        y0 = int(np.floor(y))
        y1 = min(y0 + 1, h - 1)
        fy = y - y0
        for j in range(ow):
            x = min(max((j + 0.5) * w / ow - 0.5, 0), w - 1)
            x0 = int(np.floor(x))
            x1 = min(x0 + 1, w - 1)
            fx = x - x0
            out[i, j] = (
                img[y0, x0] * (1 - fy) * (1 - fx)
                + img[y0, x1] * (1 - fy) * fx
                + img[y1, x0] * fy * (1 - fx)
                + img[y1, x1] * fy * fx
            )
    return out


def _fixture_dir(root):
    pngs.write(f"{root}/red.png", pngs.red())
    pngs.write(f"{root}/grad.png", pngs.gradient())
    pngs.write(f"{root}/same.png", pngs.gradient(64, 64))
    pngs.write(f"{root}/gray.png", np.full((5, 5), 77, np.uint8))
    rgba = np.zeros((3, 3, 4), np.uint8)
    rgba[..., 0], rgba[..., 1], rgba[..., 2], rgba[..., 3] = 1, 2, 3, 99
    pngs.write(f"{root}/rgba.png", rgba)
    pngs.write(f"{root}/a b.png", pngs.red(2, 2))
    pngs.write(f"{root}/UPPER.PNG", pngs.red(2, 2))
    pngs.write(f"{root}/sub/inner.png", pngs.red(2, 2))
    with open(f"{root}/notes.txt", "w") as f:
        f.write("pas une image")
    with open(f"{root}/broken.png", "wb") as f:
        f.write(os.urandom(64))
    open(f"{root}/empty.jpg", "wb").close()
    return root


def test_resize_matches_reference_loops():
    img = pngs.gradient().astype(np.float64)
    assert np.allclose(resize_bilinear(img, 64, 64), numpy_bilinear(img, 64, 64))
    assert np.allclose(resize_bilinear(img, 200, 30), numpy_bilinear(img, 200, 30))
    same = pngs.gradient(64, 64)
    assert np.array_equal(resize_bilinear(same, 64, 64), same.astype(np.float64))


def test_scan_decode_and_features(spark, tmpdir_fresh):
    root = _fixture_dir(tmpdir_fresh)
    scan = I.read_images(spark, root)
    names = {r.path.rsplit("/", 1)[-1] for r in scan.select("path").collect()}
    # glob is case-sensitive, top level only, never matches .txt; the image
    # source yields no row for a 0-byte file (and does not fail)
    assert names == {"red.png", "grad.png", "same.png", "gray.png", "rgba.png", "a b.png", "broken.png"}
    good, bad = I.split_valid(scan)
    rejected = {r.path.rsplit("/", 1)[-1] for r in bad.collect()}
    assert rejected == {"broken.png"}
    feats = {r.path.rsplit("/", 1)[-1]: np.array(r.pixels) for r in I.image_features(scan, 64, 64).collect()}
    assert set(feats) == names - rejected
    red = feats["red.png"].reshape(64, 64, 3)
    assert np.allclose(red[..., 0], 1.0) and np.allclose(red[..., 1], 10 / 255) and np.allclose(red[..., 2], 0)
    grey = feats["gray.png"].reshape(64, 64, 3)
    assert np.allclose(grey, 77 / 255)
    rgba = feats["rgba.png"].reshape(64, 64, 3)
    assert np.allclose(rgba[0, 0], [1 / 255, 2 / 255, 3 / 255])
    same = feats["same.png"].reshape(64, 64, 3)
    assert np.allclose(same, pngs.gradient(64, 64) / 255.0, atol=1e-7)
    grad = feats["grad.png"].reshape(64, 64, 3)
    expect = np.clip(np.rint(numpy_bilinear(pngs.gradient().astype(np.float64), 64, 64)), 0, 255) / 255.0
    assert np.allclose(grad, expect, atol=1e-6)
    # identity: plain path with the space, not %20
    assert any(p.endswith("/a b.png") for p in [r.path for r in scan.select("path").collect()])


def test_recursive_and_suffix_filter(spark, tmpdir_fresh):
    root = _fixture_dir(tmpdir_fresh)
    listing = I.read_binary_listing(spark, root, recursive=True)
    from lookout.functions.paths import has_supported_suffix

    kept = {r.path.rsplit("/", 1)[-1] for r in listing.where(has_supported_suffix(F.col("path"))).collect()}
    assert "UPPER.PNG" in kept and "inner.png" in kept and "notes.txt" not in kept
    top = {r.path.rsplit("/", 1)[-1] for r in I.read_binary_listing(spark, root).collect()}
    assert "inner.png" not in top


def test_labelled_folders_dense_and_missing(spark, tmpdir_fresh):
    root = tmpdir_fresh
    for c in range(10):
        if c == 4:
            continue  # absent class folder
        os.makedirs(f"{root}/c{c}", exist_ok=True)
        if c == 7:
            continue  # empty class folder
        for k in range(c + 1):
            pngs.write(f"{root}/c{c}/img_{k}.png", pngs.red(3, 3))
    rows, rejects, missing = I.labelled_folders(spark, root)
    assert rejects.collect() == []
    counts = dict(rows.groupBy("label").count().collect())
    assert counts == {c: c + 1 for c in range(10) if c not in (4, 7)}
    assert sorted(r.class_id for r in missing.collect()) == [4, 7]
    with_px = I.labelled_folders(spark, root, images=True, height=4, width=4).rows
    assert with_px.where(F.size("pixels") == 48).count() == sum(c + 1 for c in range(10) if c not in (4, 7))


def test_split_folders(spark, tmpdir_fresh):
    root = tmpdir_fresh
    for split, n in (("train", 3), ("val", 2), ("test", 1)):
        for cls in ("c0", "c1", "c2"):
            for k in range(n):
                pngs.write(f"{root}/{split}/{cls}/i{k}.png", pngs.red(2, 2))
    df = I.split_folders(spark, root)
    got = {(r.split, r.label): r["count"] for r in df.groupBy("split", "label").count().collect()}
    assert got == {(s, c): n for s, n in (("train", 3), ("val", 2), ("test", 1)) for c in range(3)}


def test_augmentation_deterministic_and_bounded():
    vec = (pngs.gradient(8, 8).reshape(-1) / 255.0).astype(np.float32)
    a = augment_vector(vec, 8, 8, "42:7:1")
    b = augment_vector(vec, 8, 8, "42:7:1")
    c = augment_vector(vec, 8, 8, "42:7:2")
    assert np.array_equal(a, b)
    assert not np.array_equal(a, c)
    assert a.shape == vec.shape and a.min() >= 0 and a.max() <= 1


def test_pixel_vector_rejects_bad_rows():
    assert to_pixel_vector(b"", -1, -1, -1, 8, 8) is None
    assert to_pixel_vector(b"\x01\x02", 1, 1, 3, 8, 8) is None


def test_batched_pixels_equal_single_image_path():
    import pandas as pd

    from lookout.functions.images import pixel_vectors

    rng = np.random.default_rng(0)
    imgs = [rng.integers(0, 256, (6, 9, 3), dtype=np.uint8) for _ in range(3)]
    imgs += [rng.integers(0, 256, (4, 4, 1), dtype=np.uint8), rng.integers(0, 256, (5, 7, 4), dtype=np.uint8)]
    data = pd.Series([im.tobytes() for im in imgs] + [b""])
    h = pd.Series([im.shape[0] for im in imgs] + [-1])
    w = pd.Series([im.shape[1] for im in imgs] + [-1])
    c = pd.Series([im.shape[2] for im in imgs] + [-1])
    got = pixel_vectors(data, h, w, c, 8, 8)
    for i, im in enumerate(imgs):
        want = to_pixel_vector(im.tobytes(), *im.shape, 8, 8)
        assert np.array_equal(got[i], want)
    assert got[-1] is None


def test_prepare_dataset_train_only_augmentation(spark, tmpdir_fresh):
    from lookout.operators.dataset import prepare_dataset

    root = f"{tmpdir_fresh}/train"
    rng = np.random.default_rng(3)
    for c in range(3):
        for k in range(10):
            pngs.write(f"{root}/c{c}/img_{k}.png", rng.integers(0, 256, (12, 16, 3)))
    out = prepare_dataset(spark, root, f"{tmpdir_fresh}/prepared", 8, 8, factor=2)
    rows = out.collect()
    per = {}
    for r in rows:
        per.setdefault((r.label, r.split), []).append(r)
    for c in range(3):
        val, train = per[(c, "val")], per[(c, "train")]
        assert len(val) == 2 and all(r.aug_index == 0 for r in val)  # (2*10+5) div 10
        assert len(train) == 8 * 3 and sorted({r.aug_index for r in train}) == [0, 1, 2]
    # no image is in both splits; originals equal the decoded pixels
    ids = {}
    for r in rows:
        ids.setdefault(r.path, set()).add(r.split)
    assert all(len(v) == 1 for v in ids.values())
    decoded = {r.path: np.array(r.pixels) for r in I.image_features(I.read_images(spark, root, glob=None, recursive=True), 8, 8).collect()}
    for r in rows:
        if r.aug_index == 0:
            assert np.array_equal(np.array(r.pixels), decoded[r.path])
        assert len(r.pixels) == 192 and min(r.pixels) >= 0 and max(r.pixels) <= 1


def test_affine_modes():
    from lookout.functions.images import _affine

    img = np.arange(5 * 5 * 3, dtype=np.float64).reshape(5, 5, 3)
    assert np.array_equal(_affine(img, 0.0, 1.0, "nearest", "constant"), img)
    assert np.allclose(_affine(img, 0.0, 1.0, "bilinear", "reflect"), img)
    r90 = _affine(img, 90.0, 1.0, "nearest", "constant")
    assert np.array_equal(r90, np.rot90(img, 1, axes=(0, 1)))  # counter-clockwise
    small = _affine(img, 0.0, 0.5, "nearest", "constant")  # zoom out: black border
    assert small[0, 0].sum() == 0
    refl = _affine(img, 0.0, 0.5, "nearest", "reflect")  # zoom out: reflected border
    assert refl[0, 0].sum() > 0


def test_antialias_resize_averages_blocks():
    from lookout.functions.images import resize_bilinear

    img = pngs.gradient(64, 64).astype(np.float64)
    # exact 2x reduction: each output pixel weighs the 4x4 source pixels
    # around it with a triangle filter of support 2
    got = resize_bilinear(img, 32, 32, antialias=True)
    taps = np.array([1, 3, 3, 1], dtype=np.float64) / 8.0
    kern = np.outer(taps, taps)
    pad = np.pad(img, ((1, 1), (1, 1), (0, 0)), mode="edge")
    i, j = 10, 17
    window = pad[2 * i : 2 * i + 4, 2 * j : 2 * j + 4]
    assert np.allclose(got[i, j], (window * kern[..., None]).sum(axis=(0, 1)))
    # enlargement is plain bilinear
    assert np.allclose(resize_bilinear(img, 100, 90, antialias=True), resize_bilinear(img, 100, 90))


def test_augment_batch_rows_do_not_depend_on_the_batch():
    from lookout.functions.images import KERAS_RECIPE, PREP_RECIPE, augment_batch, augment_vector

    rng = np.random.default_rng(21)
    vecs = rng.random((6, 8 * 8 * 3)).astype(np.float32)
    seeds = [f"42:{i}:{1 + i % 2}" for i in range(6)]
    for recipe in (PREP_RECIPE, KERAS_RECIPE):
        whole = augment_batch(vecs, 8, 8, seeds, recipe)
        for i in range(6):
            assert np.array_equal(whole[i], augment_vector(vecs[i], 8, 8, seeds[i], recipe))
        assert np.array_equal(augment_batch(vecs[3:], 8, 8, seeds[3:], recipe), whole[3:])


def test_untidy_folders(spark, tmpdir_fresh):
    """Stray folders, loose, nested, broken and unsupported files are rejects
    with a reason; none of them aborts the scan or becomes a class."""
    root = f"{tmpdir_fresh}/data 1"
    for name in ("c0/a.png", "c0/B.PNG", "c9/b.jpg", "other/z.png", "c10/y.png", "cover.png", "c3/deep/x.png", "cx/q.png"):
        pngs.write(f"{root}/{name}", pngs.red(3, 3))
    for name, body in (("c0/notes.txt", b"x"), ("c1/broken.png", b"not a png")):
        os.makedirs(os.path.dirname(f"{root}/{name}"), exist_ok=True)
        with open(f"{root}/{name}", "wb") as f:
            f.write(body)
    short = lambda p: p.split("data 1/", 1)[1]
    for images in (False, True):
        found = I.labelled_folders(spark, root, images=images, height=4, width=4)
        rows = {short(r.path): r.label for r in found.rows.collect()}
        rejects = {short(r.path): r.reason for r in found.rejects.collect()}
        good = {"c0/a.png": 0, "c0/B.PNG": 0, "c9/b.jpg": 9}
        assert rows == (good if images else good | {"c1/broken.png": 1})
        outside = {"other/z.png", "c10/y.png", "cover.png", "c3/deep/x.png", "cx/q.png"}
        assert {p for p, why in rejects.items() if why == "outside_class_folders"} == outside
        assert rejects["c0/notes.txt"] == "unsupported_suffix"
        assert rejects.get("c1/broken.png") == ("undecodable_image" if images else None)
        missing = {r.class_id for r in found.missing.collect()}
        assert missing == set(range(10)) - {0, 9} - (set() if images else {1})


def test_split_folders_at_their_depth_only(spark, tmpdir_fresh):
    root = tmpdir_fresh
    for name in ("train/b/1.png", "train/a/2.png", "val/a/3.png", "cover.png", "val/loose.png", "val/a/deep/4.png"):
        pngs.write(f"{root}/{name}", pngs.red(2, 2))
    got = {(r.split, r.class_folder, r.label) for r in I.split_folders(spark, root).collect()}
    assert got == {("train", "a", 0), ("train", "b", 1), ("val", "a", 0)}
    pixels = I.split_folders(spark, root, images=True, height=4, width=6).collect()
    assert len(pixels) == 3 and all(len(r.pixels) == 72 for r in pixels)


def test_prepare_dataset_again_without_a_class(spark, tmpdir_fresh):
    import shutil

    from lookout.operators.dataset import prepare_dataset

    root, out = f"{tmpdir_fresh}/train", f"{tmpdir_fresh}/prepared"
    for c in range(2):
        for k in range(5):
            pngs.write(f"{root}/c{c}/img_{k}.png", pngs.red(3, 3))
    pngs.write(f"{root}/stray/z.png", pngs.red(3, 3))
    rejects = f"{tmpdir_fresh}/rejects"
    first = prepare_dataset(spark, root, out, 4, 4, rejects_path=rejects)
    assert {r.label for r in first.select("label").collect()} == {0, 1}
    assert [r.reason for r in spark.read.parquet(rejects).collect()] == ["outside_class_folders"]
    shutil.rmtree(f"{root}/c1")
    again = prepare_dataset(spark, root, out, 4, 4)
    assert {r.label for r in again.select("label").collect()} == {0}


def test_no_shuffle_of_pixels(spark, tmpdir_fresh):
    """The rows with pixels reach the writer without an exchange."""
    from lookout.operators import dataset as D

    root = f"{tmpdir_fresh}/train"
    for c in range(2):
        for k in range(5):
            pngs.write(f"{root}/c{c}/img_{k}.png", pngs.red(3, 3))
    good = I.labelled_images(spark, root, 4, 4).rows
    split = D.stratified_split(good, "path", "label", keep_all=True, keys_from=good.select("path", "label"))
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert "pixels" in plan and "hashpartitioning" not in plan and "rangepartitioning" not in plan


def test_resize_memory_stays_near_the_batch():
    import tracemalloc

    import pandas as pd

    from lookout.functions.images import pixel_vectors

    rng = np.random.default_rng(0)
    n = 40
    frames = [rng.integers(0, 256, 480 * 640 * 3, dtype=np.uint8).tobytes() for _ in range(n)]
    series = [pd.Series(x) for x in (frames, [480] * n, [640] * n, [3] * n)]
    tracemalloc.start()
    vecs = pixel_vectors(*series, 64, 64)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(vecs) == n and peak < sum(map(len, frames))  # 37 MB of frames
    one = to_pixel_vector(frames[7], 480, 640, 3, 64, 64)
    assert np.array_equal(vecs[7], one)


def _libraries_reduction(img, oh, ow):
    """Two passes over bytes, rows first, weights as whole 2**-22 (loops)."""
    import math

    def line(v, n_out):
        scale = len(v) / n_out
        reach, out = max(scale, 1.0), []
        for o in range(n_out):
            centre = (o + 0.5) * scale
            lo, hi = max(0, math.floor(centre - reach + 0.5)), min(len(v), math.floor(centre + reach + 0.5))
            w = [max(0.0, 1 - abs((j + 0.5 - centre) / reach)) for j in range(lo, hi)]
            w = [math.floor(x / sum(w) * 2**22 + 0.5) for x in w]
            out.append(min(255, max(0, (sum(int(v[lo + j]) * x for j, x in enumerate(w)) + 2**21) >> 22)))
        return out

    rows = np.array([line(r, ow) if len(r) != ow else list(r) for r in img])
    if img.shape[0] == oh:
        return rows
    return np.array([line(c, oh) for c in rows.T]).T


def test_reduction_in_bytes_equals_loops():
    from lookout.functions.images import EIGHT_BIT, to_pixel_vector

    rng = np.random.default_rng(3)
    for (h, w), (oh, ow) in (((64, 48), (8, 12)), ((37, 53), (16, 9)), ((9, 7), (9, 3)), ((5, 6), (12, 20)), ((7, 7), (7, 7))):
        img = rng.integers(0, 256, (h, w, 3), dtype=np.uint8)
        got = resize_bilinear(img, oh, ow, EIGHT_BIT)
        for c in range(3):
            assert np.array_equal(got[..., c], _libraries_reduction(img[..., c], oh, ow))
    flat = np.full((50, 70, 3), 137, np.uint8)
    vec = to_pixel_vector(flat.tobytes(), 50, 70, 3, 8, 8, EIGHT_BIT)
    assert np.array_equal(np.rint(vec * 255), np.full(8 * 8 * 3, 137))


def test_rotation_in_bytes():
    from lookout.functions.images import _rotate_bytes

    img = np.arange(1, 82, dtype=np.uint8).reshape(1, 9, 9, 1)
    assert np.array_equal(_rotate_bytes(img, np.array([90.0]))[0, :, :, 0], np.rot90(img[0, :, :, 0]))
    assert np.array_equal(_rotate_bytes(img, np.array([180.0]))[0, ::-1, ::-1, 0], img[0, :, :, 0])
    turned = _rotate_bytes(img, np.array([45.0]))[0, :, :, 0]
    assert turned[4, 4] == img[0, 4, 4, 0] and turned[0, 0] == 0 and turned[8, 8] == 0


def test_missing_classes_and_rejects_of_the_dataset_job(spark, tmpdir_fresh):
    from lookout.functions.images import EIGHT_BIT
    from lookout.operators import dataset as D

    root = f"{tmpdir_fresh}/train"
    rng = np.random.default_rng(4)
    for c in (0, 3):
        for i in range(4):
            pngs.write(f"{root}/c{c}/{i}.png", rng.integers(0, 256, (20, 24, 3)))
    with open(f"{root}/c3/bad.png", "wb") as f:
        f.write(b"not an image")
    table = D.prepare_dataset(
        spark, root, f"{tmpdir_fresh}/out", 8, 8, antialias=EIGHT_BIT,
        rejects_path=f"{tmpdir_fresh}/rejects", missing_path=f"{tmpdir_fresh}/missing",
    )
    assert table.where("aug_index = 0").count() == 8
    missing = sorted(r.class_id for r in spark.read.parquet(f"{tmpdir_fresh}/missing").collect())
    assert missing == [1, 2, 4, 5, 6, 7, 8, 9]
    assert [r.reason for r in spark.read.parquet(f"{tmpdir_fresh}/rejects").collect()] == ["undecodable_image"]
