"""Image files for the registered queries and tests: PNGs written by the tasks
from a pixel table that Spark derives from the driver tables."""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lookout.session import local_fs_path


def encode_png(pixels: np.ndarray, height: int, width: int, channels: int) -> bytes:
    """8-bit PNG (grey, RGB or RGBA) from row-major pixel values 0..255."""
    color_type = {1: 0, 3: 2, 4: 6}[channels]
    arr = np.clip(np.rint(np.asarray(pixels, dtype=np.float64)), 0, 255).astype(np.uint8).reshape(height, width * channels)
    raw = b"".join(b"\x00" + arr[r].tobytes() for r in range(height))

    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body) & 0xFFFFFFFF)

    header = struct.pack(">IIBBBBB", width, height, 8, color_type, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def write_png_files(
    df: DataFrame,
    root: str,
    id_col: str,
    pixels_col: str,
    height: int,
    width: int,
    channels: int,
    folder_cols: Sequence[str] = (),
    prefix: str = "img_",
) -> DataFrame:
    """Write one PNG per row of a 0..255 pixel table to
    ``<root>/<folder_cols...>/<prefix><id>.png``, in parallel from the
    tasks through the file system of the path (local, HDFS, S3 via
    ``pyarrow.fs``). Returns ``(id, path, n_bytes)`` lazily; run an action
    to write."""
    import pyarrow.fs as pafs

    schema = T.StructType(
        [
            T.StructField(id_col, T.LongType(), True),
            T.StructField("path", T.StringType(), True),
            T.StructField("n_bytes", T.LongType(), True),
        ]
    )
    cols = [id_col, pixels_col, *folder_cols]

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if root.startswith("file:") or "://" not in root:
            fs, base = pafs.LocalFileSystem(), local_fs_path(root)
        else:
            fs, base = pafs.FileSystem.from_uri(root)
        made: set[str] = set()
        # Files are written in a hidden folder of the task, then moved: a
        # watching stream never lists a half-written file, a retried or
        # speculative task just replaces the same content, and tasks do not
        # wait for each other's turn in the shared folder while they write.
        staging = f"{base.rstrip('/')}/.writing-{uuid.uuid4().hex}"
        try:
            for pdf in batches:
                ids, paths, sizes = [], [], []
                for row in pdf.itertuples(index=False):
                    rid, px = row[0], row[1]
                    folder = "/".join([base.rstrip("/")] + [str(v) for v in row[2:]])
                    if not made:
                        fs.create_dir(staging, recursive=True)
                    if folder not in made:
                        fs.create_dir(folder, recursive=True)
                        made.add(folder)
                    body = encode_png(np.asarray(px), height, width, channels)
                    target = f"{folder}/{prefix}{rid}.png"
                    draft = f"{staging}/{prefix}{rid}.png"
                    with fs.open_output_stream(draft) as out:
                        out.write(body)
                    fs.move(draft, target)
                    ids.append(rid)
                    paths.append(target)
                    sizes.append(len(body))
                yield pd.DataFrame({id_col: ids, "path": paths, "n_bytes": sizes})
        finally:
            if made:
                fs.delete_dir(staging)

    return df.select(*cols).mapInPandas(write, schema)
