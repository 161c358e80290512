"""PNG fixtures written with zlib + struct (no imaging library here)."""

import os

import numpy as np

from lookout.plans.fixtures import encode_png


def write(path, arr):
    arr = np.asarray(arr, dtype=np.uint8)
    h, w = arr.shape[:2]
    c = 1 if arr.ndim == 2 else arr.shape[2]
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(encode_png(arr.reshape(-1), h, w, c))


def red(h=6, w=4):
    a = np.zeros((h, w, 3), np.uint8)
    a[..., 0], a[..., 1], a[..., 2] = 255, 10, 0
    return a


def gradient(h=96, w=128):
    yy, xx = np.mgrid[0:h, 0:w]
    return np.stack([(xx * 2) % 256, (yy * 2) % 256, (xx + yy) % 256], axis=2).astype(np.uint8)
