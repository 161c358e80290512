"""Image functions (F1-F3, F14, F15, D1): decoded rasters -> fixed-size RGB
pixel vectors, and seeded augmentation.

Decoding happens in the JVM (Spark's ``image`` source); what is left --
channel order, resize, scaling, augmentation -- is NumPy inside Arrow-batched
pandas UDFs, one small helper per image. Spark partitions and schedules the
work; nothing here collects or loops on the driver.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lookout.session import prepare_active

# Schema of Spark's ``image`` data source (needed to stream it).
IMAGE_SCHEMA = T.StructType(
    [
        T.StructField(
            "image",
            T.StructType(
                [
                    T.StructField("origin", T.StringType(), True),
                    T.StructField("height", T.IntegerType(), True),
                    T.StructField("width", T.IntegerType(), True),
                    T.StructField("nChannels", T.IntegerType(), True),
                    T.StructField("mode", T.IntegerType(), True),
                    T.StructField("data", T.BinaryType(), True),
                ]
            ),
            True,
        )
    ]
)

PIXELS_TYPE = T.ArrayType(T.FloatType())
# Bytes of frames of one size that are resized together.
STACK_BYTES = 8 * 1024 * 1024


# --- raster helpers (NumPy, one image) -------------------------------------------


def to_rgb(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """Spark image bytes (BGR / BGRA / grey, row-major) -> ``H x W x 3`` RGB
    uint8: channels reordered, alpha dropped, grey replicated."""
    arr = np.frombuffer(data, dtype=np.uint8)
    if channels == 1:
        g = arr.reshape(height, width, 1)
        return np.repeat(g, 3, axis=2)
    img = arr.reshape(height, width, channels)
    return np.ascontiguousarray(img[:, :, 2::-1])  # B,G,R(,A) -> R,G,B


def _axis(n_in: int, n_out: int):
    # Half-pixel centres: output sample i sits at (i + 0.5) * n_in / n_out - 0.5.
    pos = (np.arange(n_out, dtype=np.float64) + 0.5) * (n_in / n_out) - 0.5
    pos = np.clip(pos, 0.0, n_in - 1)
    lo = np.floor(pos).astype(np.int64)
    hi = np.minimum(lo + 1, n_in - 1)
    return lo, hi, pos - lo


def _antialias_weights(n_in: int, n_out: int) -> np.ndarray:
    """``n_out x n_in`` weights of a triangle filter whose support widens
    with the reduction factor (area-aware bilinear, as image libraries
    downsample); rows sum to 1. For enlargement it is plain bilinear."""
    scale = n_in / n_out
    support = max(scale, 1.0)
    centres = (np.arange(n_out, dtype=np.float64) + 0.5) * scale
    taps = np.arange(n_in, dtype=np.float64) + 0.5
    w = np.clip(1.0 - np.abs(taps[None, :] - centres[:, None]) / support, 0.0, None)
    return w / w.sum(axis=1, keepdims=True)


# ``antialias`` of the resize functions: this value asks for the filter of the
# reference's dataset job, exact to the byte.
EIGHT_BIT = "8bit"
# Fixed value (must equal the reference's image library): bits of a weight
# behind the point.
WEIGHT_BITS = 22


def filter_taps(n_in: int, n_out: int) -> tuple[np.ndarray, np.ndarray]:
    """(first source index, weights) for each output sample along one axis: a
    triangle filter as wide as the reduction (one pixel for an enlargement),
    cut off at the border and scaled to sum to one, as whole numbers of
    ``2**-WEIGHT_BITS``. Rows are padded with zero weights."""
    scale = n_in / n_out
    reach = max(scale, 1.0)
    centre = (np.arange(n_out) + 0.5) * scale
    first = np.maximum(np.floor(centre - reach + 0.5), 0).astype(np.int64)
    last = np.minimum(np.floor(centre + reach + 0.5), n_in).astype(np.int64)
    at = first[:, None] + np.arange((last - first).max())[None, :]
    w = np.maximum(0.0, 1.0 - np.abs((at + 0.5 - centre[:, None]) / reach))
    w[at >= last[:, None]] = 0.0
    w /= w.sum(axis=1, keepdims=True)
    return first, np.floor(w * (1 << WEIGHT_BITS) + 0.5).astype(np.int64)


def _filter_axis(imgs: np.ndarray, axis: int, n_out: int) -> np.ndarray:
    """One pass of the filter over bytes: whole-number sums, rounded and held
    in 8 bits again. Takes one tap of every output sample at a time."""
    n_in = imgs.shape[axis]
    if n_in == n_out:
        return imgs
    first, weights = filter_taps(n_in, n_out)
    shape = [1] * imgs.ndim
    shape[axis] = n_out
    total = np.full((*imgs.shape[:axis], n_out, *imgs.shape[axis + 1 :]), 1 << (WEIGHT_BITS - 1), np.int64)
    for k in range(weights.shape[1]):
        tap = np.take(imgs, np.minimum(first + k, n_in - 1), axis=axis)
        total += tap * weights[:, k].reshape(shape)
    return np.clip(total >> WEIGHT_BITS, 0, 255).astype(np.uint8)


def resize_bilinear(img: np.ndarray, height: int, width: int, antialias: bool | str = False) -> np.ndarray:
    """Bilinear resize with half-pixel centres, aspect not kept (F2). The
    identity when the size is unchanged. With ``antialias`` a reduction
    averages every source pixel under the output pixel (triangle filter
    scaled by the factor); with ``EIGHT_BIT`` it does so in two passes over
    bytes, rows first, with weights as whole numbers and bytes in between, as
    image libraries do. Returns float64 in the input's value range."""
    return resize_bilinear_batch(img[None], height, width, antialias)[0]


def to_pixel_vector(
    data: bytes, height: int, width: int, channels: int, out_h: int, out_w: int, antialias: bool | str = False
) -> np.ndarray | None:
    """F1-F3 for one decoded image: RGB, resize, round to 8 bits, flatten
    row-major interleaved R,G,B, scale by 1/255 (float32). ``None`` for an
    undecodable row (height -1)."""
    if data is None or height is None or height <= 0 or width <= 0 or channels not in (1, 3, 4):
        return None
    if len(data) != height * width * channels:
        return None
    rgb = to_rgb(data, height, width, channels)
    resized = np.clip(np.rint(resize_bilinear(rgb, out_h, out_w, antialias)), 0, 255)
    return (resized.astype(np.float32) / np.float32(255.0)).reshape(-1)


def resize_bilinear_batch(imgs: np.ndarray, height: int, width: int, antialias: bool | str = False) -> np.ndarray:
    """:func:`resize_bilinear` for a stack ``N x H x W x C`` of same-size
    images: one vectorised gather (or two small matrix products, or two
    passes of a few taps) for the whole stack."""
    h, w = imgs.shape[1:3]
    if (h, w) == (height, width):
        return imgs.astype(np.float64)
    if antialias == EIGHT_BIT:
        return _filter_axis(_filter_axis(imgs, 2, width), 1, height).astype(np.float64)
    if antialias:
        wy, wx = _antialias_weights(h, height), _antialias_weights(w, width)
        return np.einsum("oh,nhwc,pw->nopc", wy, imgs.astype(np.float64), wx, optimize=True)
    y0, y1, wy = _axis(h, height)
    x0, x1, wx = _axis(w, width)
    wx = wx[None, None, :, None]
    wy = wy[None, :, None, None]

    def row(y: np.ndarray) -> np.ndarray:
        # The taps are gathered as bytes; only they become floats.
        left, right = imgs[:, y[:, None], x0[None, :]], imgs[:, y[:, None], x1[None, :]]
        return left.astype(np.float64) * (1 - wx) + right.astype(np.float64) * wx

    return row(y0) * (1 - wy) + row(y1) * wy


def pixel_vectors(
    data: pd.Series,
    height: pd.Series,
    width: pd.Series,
    channels: pd.Series,
    out_h: int,
    out_w: int,
    antialias: bool | str = False,
) -> list:
    """F1-F3 for an Arrow batch: rows of the same (height, width, channels)
    -- the usual case for one camera -- are stacked and resized together;
    undecodable rows give ``None``."""
    out: list = [None] * len(data)
    shapes: dict = {}
    for i, (d, h, w, c) in enumerate(zip(data, height, width, channels)):
        if d is None or h is None or pd.isna(h) or h <= 0 or w <= 0 or c not in (1, 3, 4):
            continue
        h, w, c = int(h), int(w), int(c)
        if len(d) != h * w * c:
            continue
        shapes.setdefault((h, w, c), []).append(i)
    for (h, w, c), every in shapes.items():
        step = max(1, STACK_BYTES // (max(h * w, out_h * out_w) * 3 * (8 if antialias else 1)))
        for idx in (every[k : k + step] for k in range(0, len(every), step)):
            stack = np.frombuffer(b"".join(data.iloc[i] for i in idx), dtype=np.uint8).reshape(len(idx), h, w, c)
            rgb = np.repeat(stack, 3, axis=3) if c == 1 else stack[..., 2::-1]
            resized = np.clip(np.rint(resize_bilinear_batch(rgb, out_h, out_w, antialias)), 0, 255)
            flat = (resized.astype(np.float32) / np.float32(255.0)).reshape(len(idx), -1)
            for j, i in enumerate(idx):
                out[i] = flat[j]
    return out


def pixel_vectors_udf(out_h: int = 64, out_w: int = 64, antialias: bool | str = False):
    """Arrow-batched UDF (D1): the image struct's fields -> pixel vector,
    null for undecodable rows (routed to rejects by the caller)."""
    prepare_active()

    @F.pandas_udf(PIXELS_TYPE)
    def pixels(data: pd.Series, height: pd.Series, width: pd.Series, channels: pd.Series) -> pd.Series:
        return pd.Series(pixel_vectors(data, height, width, channels, out_h, out_w, antialias), dtype=object)

    return pixels


def pixel_vector(image_col: str = "image", out_h: int = 64, out_w: int = 64, antialias: bool | str = False) -> Column:
    """Column expression: decoded ``image`` struct -> float pixel vector."""
    udf = pixel_vectors_udf(out_h, out_w, antialias)
    im = F.col(image_col)
    return udf(im["data"], im["height"], im["width"], im["nChannels"])


# --- augmentation (F14 / F15) --------------------------------------------------------

# Fixed values (must equal the reference): augmentation ranges of the two
# recipes. Recipe "prep": horizontal flip with probability 0.5, rotation
# within +-15 degrees, brightness factor 0.7..1.3, contrast factor 0.8..1.2.
# Recipe "keras": rotation within +-5 % of a full turn, zoom within +-10 %.
PREP_RECIPE = {"flip_p": 0.5, "max_degrees": 15.0, "brightness": (0.7, 1.3), "contrast": (0.8, 1.2), "zoom": None}
KERAS_RECIPE = {"flip_p": 0.0, "max_degrees": 0.05 * 360.0, "brightness": None, "contrast": None, "zoom": 0.1}
# Sampling of the geometric step: the first recipe rotates with nearest
# neighbour and black fill, the second samples bilinearly with reflected
# borders (the defaults of the libraries those recipes name).
# The first one's library holds an image in bytes between its steps.
PREP_RECIPE.update(resample="nearest", fill="constant", steps=EIGHT_BIT)
KERAS_RECIPE.update(resample="bilinear", fill="reflect")


def draw(seed_text: str, name: str, low: float = 0.0, high: float = 1.0) -> float:
    """A number in [low, high) from the first 32 bits of ``md5(seed:name)``:
    every parameter of a copy has its own, and SQL can compute it too."""
    u = int(hashlib.md5(f"{seed_text}:{name}".encode()).hexdigest()[:8], 16) / 2.0**32
    return low + u * (high - low)


def _reflect(i: np.ndarray, n: int) -> np.ndarray:
    # Symmetric reflection with the edge repeated: d c b a | a b c d | d c b a
    period = 2 * n
    i = np.mod(i, period)
    return np.where(i >= n, period - 1 - i, i)


def _affine_batch(
    imgs: np.ndarray, degrees: np.ndarray, scales: np.ndarray, resample: str = "nearest", fill: str = "constant"
) -> np.ndarray:
    """Rotate each image of ``N x H x W x C`` counter-clockwise by its
    ``degrees`` and zoom it by its ``scale`` about the centre, in one
    vectorised gather. ``resample``: ``nearest`` or ``bilinear``; ``fill``:
    ``constant`` (black outside) or ``reflect``."""
    n, h, w, c = imgs.shape
    t = np.deg2rad(np.asarray(degrees, dtype=np.float64))[:, None, None]
    sc = np.asarray(scales, dtype=np.float64)[:, None, None]
    cy, cx = (h - 1) / 2.0, (w - 1) / 2.0
    yy, xx = np.mgrid[0:h, 0:w].astype(np.float64)
    dy, dx = (yy - cy)[None] / sc, (xx - cx)[None] / sc
    # inverse map: output pixel -> source position (y axis points down)
    sx = np.cos(t) * dx - np.sin(t) * dy + cx
    sy = np.sin(t) * dx + np.cos(t) * dy + cy
    rows = np.arange(n)[:, None, None]

    def sample(yi: np.ndarray, xi: np.ndarray) -> np.ndarray:
        if fill == "reflect":
            return imgs[rows, _reflect(yi, h), _reflect(xi, w)]
        ok = (yi >= 0) & (yi < h) & (xi >= 0) & (xi < w)
        vals = imgs[rows, np.clip(yi, 0, h - 1), np.clip(xi, 0, w - 1)]
        return np.where(ok[..., None], vals, 0.0)

    if resample == "nearest":
        return sample(np.floor(sy + 0.5).astype(int), np.floor(sx + 0.5).astype(int)).astype(np.float64)
    x0, y0 = np.floor(sx).astype(int), np.floor(sy).astype(int)
    fx, fy = (sx - x0)[..., None], (sy - y0)[..., None]
    out = np.zeros((n, h, w, c), dtype=np.float64)
    for oy, ox, wgt in ((0, 0, (1 - fy) * (1 - fx)), (0, 1, (1 - fy) * fx), (1, 0, fy * (1 - fx)), (1, 1, fy * fx)):
        out += sample(y0 + oy, x0 + ox) * wgt
    return out


def _affine(img: np.ndarray, degrees: float, scale: float, resample: str = "nearest", fill: str = "constant") -> np.ndarray:
    """:func:`_affine_batch` for one ``H x W x C`` image."""
    return _affine_batch(img[None].astype(np.float64), [degrees], [scale], resample, fill)[0]


# Fixed values (must equal the reference's image library): weights of red, green
# and blue in a grey byte, as 65536ths.
LUMA = (19595, 38470, 7471)


def _luma(img: np.ndarray) -> np.ndarray:
    """Grey bytes of RGB bytes."""
    r, g, b = (img[..., k].astype(np.int64) * w for k, w in enumerate(LUMA))
    return (r + g + b + 0x8000) >> 16


def _rotate_bytes(imgs: np.ndarray, degrees: np.ndarray) -> np.ndarray:
    """Each image of ``N x H x W x C`` turned counter-clockwise about its
    centre: the nearest source pixel, black outside. Positions are whole
    numbers of 65536ths, so that they agree wherever they are worked out."""
    n, h, w, _ = imgs.shape
    t = np.asarray(degrees, dtype=np.float64) * (np.pi / 180.0)
    cos, sin = np.cos(t), np.sin(t)

    def fixed(v: np.ndarray) -> np.ndarray:
        return np.floor(v * 65536.0 + 0.5).astype(np.int64)[:, None, None]

    x0 = fixed(w / 2.0 - cos * (w / 2.0) + sin * (h / 2.0) + cos * 0.5 - sin * 0.5)
    y0 = fixed(h / 2.0 - sin * (w / 2.0) - cos * (h / 2.0) + sin * 0.5 + cos * 0.5)
    yy, xx = np.mgrid[0:h, 0:w]
    sx = (x0 + xx * fixed(cos) - yy * fixed(sin)) >> 16
    sy = (y0 + xx * fixed(sin) + yy * fixed(cos)) >> 16
    inside = (sx >= 0) & (sx < w) & (sy >= 0) & (sy < h)
    got = imgs[np.arange(n)[:, None, None], np.clip(sy, 0, h - 1), np.clip(sx, 0, w - 1)]
    return np.where(inside[..., None], got, 0).astype(np.uint8)


def _blend_bytes(base: np.ndarray, imgs: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """``base + factor * (image - base)`` in single precision, cut off to bytes."""
    by = factor.astype(np.float32)[:, None, None, None]
    mixed = base.astype(np.float32) + by * (imgs.astype(np.float32) - base.astype(np.float32))
    return np.clip(mixed, 0, 255).astype(np.uint8)


def _augment_bytes(
    vecs: np.ndarray,
    height: int,
    width: int,
    flip: np.ndarray,
    degrees: np.ndarray,
    bright: np.ndarray,
    contrast: np.ndarray,
) -> np.ndarray:
    """Flip, rotation, brightness and contrast on images held in bytes: cut
    off after every step, the mean grey rounded."""
    n = len(vecs)
    img = (np.asarray(vecs, dtype=np.float32) * np.float32(255)).astype(np.uint8).reshape(n, height, width, 3)
    img[flip] = img[flip][:, :, ::-1]
    turned = degrees != 0
    if turned.any():
        img[turned] = _rotate_bytes(img[turned], degrees[turned])
    img = _blend_bytes(np.zeros((n, 1, 1, 1)), img, bright)
    mean = np.floor(_luma(img).reshape(n, -1).mean(axis=1) + 0.5)[:, None, None, None]
    img = _blend_bytes(mean, img, contrast)
    return (img.astype(np.float32) / np.float32(255.0)).reshape(n, -1)


def augment_batch(vecs: np.ndarray, height: int, width: int, seeds, recipe: dict = PREP_RECIPE) -> np.ndarray:
    """Augmented copies of ``N`` pixel vectors in [0, 1] (``N x H*W*3``),
    copy ``n`` reproducible from ``seeds[n]`` alone: each row draws its own
    parameters, and every step is computed per row (the result does not
    depend on which rows share a batch), so a retried task produces the same
    copies. The steps themselves run vectorised over the whole batch."""
    n = len(seeds)
    flip = np.zeros(n, dtype=bool)
    deg, scale = np.zeros(n), np.ones(n)
    bright, contrast = np.ones(n), np.ones(n)
    for i, seed_text in enumerate(seeds):
        if recipe.get("flip_p"):
            flip[i] = draw(seed_text, "flip") < recipe["flip_p"]
        if recipe.get("max_degrees"):
            deg[i] = draw(seed_text, "degrees", -recipe["max_degrees"], recipe["max_degrees"])
        if recipe.get("zoom"):
            scale[i] = 1.0 + draw(seed_text, "zoom", -recipe["zoom"], recipe["zoom"])
        if recipe.get("brightness"):
            bright[i] = draw(seed_text, "brightness", *recipe["brightness"])
        if recipe.get("contrast"):
            contrast[i] = draw(seed_text, "contrast", *recipe["contrast"])
    img = np.asarray(vecs, dtype=np.float64).reshape(n, height, width, 3) * 255.0
    if recipe.get("steps") == EIGHT_BIT:
        return _augment_bytes(vecs, height, width, flip, deg, bright, contrast)
    img[flip] = img[flip][:, :, ::-1]
    moving = (deg != 0) | (scale != 1.0)
    if moving.any():
        img[moving] = _affine_batch(
            img[moving], deg[moving], scale[moving], recipe.get("resample", "nearest"), recipe.get("fill", "constant")
        )
    if recipe.get("brightness"):
        img = np.clip(img * bright[:, None, None, None], 0, 255)
    if recipe.get("contrast"):
        grey = 0.299 * img[..., 0] + 0.587 * img[..., 1] + 0.114 * img[..., 2]
        mean = np.rint(grey.reshape(n, -1).mean(axis=1))[:, None, None, None]
        img = mean + (img - mean) * contrast[:, None, None, None]
    img = np.clip(np.rint(img), 0, 255)
    return (img.astype(np.float32) / np.float32(255.0)).reshape(n, -1)


def augment_vector(vec: np.ndarray, height: int, width: int, seed_text: str, recipe: dict = PREP_RECIPE) -> np.ndarray:
    """One augmented copy of a [0, 1] pixel vector, reproducible from
    ``seed_text`` (so a retried task produces the same copy)."""
    return augment_batch(np.asarray(vec)[None], height, width, [seed_text], recipe)[0]


def augment_udf(height: int, width: int, recipe: dict = PREP_RECIPE, seed: int = 42):
    """Arrow-batched UDF: (pixels, id, copy index) -> augmented pixels; copy
    index 0 returns the original unchanged. The copies of a batch are
    augmented together (:func:`augment_batch`)."""
    prepare_active()

    @F.pandas_udf(PIXELS_TYPE)
    def augment(pixels: pd.Series, ids: pd.Series, k: pd.Series) -> pd.Series:
        out: list = [None] * len(pixels)
        todo = []
        for pos, (vec, i, j) in enumerate(zip(pixels, ids, k)):
            if vec is None:
                continue
            if int(j) == 0:
                out[pos] = np.asarray(vec, dtype=np.float32)
            else:
                todo.append((pos, vec, f"{seed}:{i}:{int(j)}"))
        if todo:
            done = augment_batch(np.stack([t[1] for t in todo]), height, width, [t[2] for t in todo], recipe)
            for (pos, _, _), row in zip(todo, done):
                out[pos] = row
        return pd.Series(out, dtype=object)

    return augment
