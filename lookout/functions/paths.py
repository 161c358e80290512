"""Path functions (F9, F10, F12, S2, S3) as native column expressions.

Everything here is a chain of built-in expressions, so it stays inside
whole-stage codegen and costs nothing extra at scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values (must equal the reference): file suffixes accepted by the
# dataset scan (case-insensitive) and the glob of the streaming scan
# (case-sensitive).
SUPPORTED_SUFFIXES = [".jpg", ".jpeg", ".png", ".bmp"]
STREAM_GLOB = "*.{png,jpg,jpeg}"
STREAM_GLOB_SUFFIXES = [".png", ".jpg", ".jpeg"]


def url_unquote(p: Column) -> Column:
    """Percent-decoding like ``urllib.parse.unquote``: ``+`` stays ``+``.

    ``url_decode`` is form decoding (``+`` -> space), so ``+`` is escaped
    first, and so is a ``%`` that starts no escape (it stays as it is, the
    valid escapes around it are decoded)."""
    kept = F.regexp_replace(F.replace(p, F.lit("+"), F.lit("%2B")), "%(?![0-9A-Fa-f]{2})", "%25")
    return F.coalesce(F.try_url_decode(kept), p)


def _local_path_steps(project_root: str, windows: bool):
    """The F9 rewrite as a list of steps ``prev -> next``; each step reads the
    previous value as a plain column so that no stage is recomputed."""
    root = project_root.rstrip("/\\")
    steps = [
        lambda p: url_unquote(p),
        lambda p: F.regexp_replace(F.regexp_replace(p, r"^file:", ""), r"^/+", "/"),
    ]
    if not windows:
        steps += [
            lambda p: F.when(
                p.rlike(r"^[a-zA-Z]:/"),
                F.concat(F.lit("/mnt/"), F.lower(F.substring(p, 1, 1)), F.lit("/"), F.substring(p, 4, 1 << 30)),
            ).otherwise(p),
            lambda p: F.replace(
                F.when(p.startswith("/"), p).otherwise(F.concat(F.lit(root + "/"), p)), F.lit("\\"), F.lit("/")
            ),
        ]
    else:
        steps += [
            lambda p: F.when(p.startswith("/mnt/c/"), F.concat(F.lit("C:/"), F.substring(p, 8, 1 << 30))).otherwise(
                F.when(
                    p.rlike(r"^/[a-zA-Z]/"), F.concat(F.substring(p, 2, 1), F.lit(":"), F.substring(p, 3, 1 << 30))
                ).otherwise(p)
            ),
            lambda p: F.replace(
                F.when(p.rlike(r"^.:") | p.startswith("/") | p.startswith("\\"), p).otherwise(
                    F.concat(F.lit(root + "\\"), p)
                ),
                F.lit("/"),
                F.lit("\\"),
            ),
        ]
    return steps


def to_local_path(uri: Column, project_root: str = "/app", windows: bool = False) -> Column:
    """Image URI as written by the stream -> local path the viewer can open.

    POSIX branch (default): unquote, strip ``file:``, collapse leading
    slashes, map ``X:/`` drive letters to ``/mnt/x/``, make relative paths
    absolute under ``project_root``, turn ``\\`` into ``/``.
    Windows branch: map ``/mnt/x/`` back to ``X:/`` and make relative
    paths absolute; separators become ``\\``.

    As one nested expression some steps repeat their input; for large
    tables prefer :func:`with_local_path`, which stages the steps."""
    p = uri
    for step in _local_path_steps(project_root, windows):
        p = step(p)
    return F.when(uri.isNotNull(), p)


def with_local_path(
    df: DataFrame, src: str, out: str = "local_path", project_root: str = "/app", windows: bool = False
) -> DataFrame:
    """Add ``out`` = F9 of ``src``, one projection per step: each value is
    computed once per row (Catalyst does not inline a non-cheap expression
    that the next step reads several times)."""
    tmp = f"__{out}_step"
    staged = df.withColumn(tmp, F.col(src))
    for step in _local_path_steps(project_root, windows):
        staged = staged.withColumn(tmp, step(F.col(tmp)))
    return staged.withColumn(out, F.when(F.col(src).isNotNull(), F.col(tmp))).drop(tmp)


def base_name(p: Column) -> Column:
    """Last path component (F10); a trailing separator gives ``""``."""
    return F.substring_index(p, "/", -1)


def file_suffix(p: Column) -> Column:
    """Lower-cased suffix with its dot (F12); ``""`` when the name has none.

    Like ``PurePath.suffix``: a leading dot alone (``.bashrc``) is no
    suffix."""
    name = base_name(p)
    return F.lower(F.regexp_extract(name, r".(\.[^.]+)$", 1))


def has_supported_suffix(p: Column) -> Column:
    """Case-insensitive dataset filter (S3)."""
    return file_suffix(p).isin(*SUPPORTED_SUFFIXES)


def matches_stream_glob(p: Column) -> Column:
    """Row-level twin of ``pathGlobFilter="*.{png,jpg,jpeg}"`` (S2): the file
    name ends with one of the suffixes, case-sensitive."""
    name = base_name(p)
    cond = F.lit(False)
    for s in STREAM_GLOB_SUFFIXES:
        cond = cond | name.endswith(s)
    return cond
