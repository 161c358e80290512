"""Exact global ranks without a single-partition window (W7, W8, W10, W11,
W12), and seeded shuffle keys.

``row_number() OVER (ORDER BY k)`` with no partition pulls every row into
one task. Instead rows are cut into buckets that are contiguous ranges of
the order (the first hex digits of an md5 key, or Spark's own range
partitions of a natural key), counted per bucket, and the small bucket table
gives each bucket its offset. Each row's rank is its offset plus its
``row_number`` inside its own bucket, so the work is spread over as many
tasks as there are buckets, and a hot group (``partition_cols``) is split
into all of its buckets as well.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lookout.session import prepare

# Groups whose threshold table is broadcast (its size is counted first); a
# larger table is joined by a shuffle.
BROADCAST_GROUPS = 100_000


def shuffle_key(id_col, seed: int = 42) -> Column:
    """Reproducible pseudo-random key ``md5("<seed>:<id>")``; independent
    of partitioning, retries and executor count (unlike ``rand(seed)``)."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    # A null id hashes as "" (as SQL concat that skips NULL): never a null
    # key, so the row keeps a bucket and is never dropped.
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(c.cast("string"), F.lit(""))))


def hash_digits(n_rows: int) -> int:
    """Hex digits that cut ``n_rows`` hash-ordered rows into about
    sqrt(n_rows) buckets: neither the bucket table nor a bucket outgrows a
    task (at 1e12 rows: a million buckets of a million rows)."""
    return max(3, min(14, math.ceil(math.log2(max(n_rows, 2)) / 8)))


def hash_bucket(key: str, digits: int) -> Column:
    """Bucket of an md5-hex key: its first ``digits`` hex digits (ordered
    like the key)."""
    return F.conv(F.substring(F.col(key), 1, digits), 16, 10).cast("long")


def global_rank(
    df: DataFrame,
    order_cols: Sequence[str],
    bucket: Column,
    partition_cols: Sequence[str] = (),
    rank_col: str = "rank",
    count_col: str | None = None,
) -> DataFrame:
    """Exact ``row_number() OVER (PARTITION BY partition_cols ORDER BY
    order_cols)`` (1-based, ascending). ``bucket`` must be non-decreasing in
    the order and ``order_cols`` must be unique within a partition.

    With ``count_col`` the size of each partition is added too (the total
    when there is no partition column)."""
    parts = list(partition_cols)
    b = df.withColumn("_bkt", bucket)
    counts = b.groupBy(*parts, "_bkt").agg(F.count(F.lit(1)).alias("_bn"))
    before = Window.partitionBy(*parts).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    # The windows below run over the bucket table: (groups x buckets) rows.
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_bn").over(before), F.lit(0)))
    if count_col:
        offsets = offsets.withColumn(count_col, F.sum("_bn").over(Window.partitionBy(*parts)))
    offsets = offsets.drop("_bn")
    inside = Window.partitionBy(*parts, "_bkt").orderBy(*order_cols)
    ranked = b.withColumn("_rn", F.row_number().over(inside))
    # No broadcast hint: AQE broadcasts the offsets at run time when their
    # measured size is under the threshold, and shuffles them otherwise.
    # Null-safe on the group columns: a null group is a group (as in
    # PARTITION BY) and keeps its rows.
    joined = _join_null_safe(ranked, offsets, [*parts, "_bkt"], "inner") if parts else ranked.join(offsets, "_bkt")
    out = joined.withColumn(rank_col, F.col("_off") + F.col("_rn"))
    return out.drop("_bkt", "_rn", "_off")


def rank_by_hash(
    df: DataFrame,
    id_col: str,
    seed: int = 42,
    partition_cols: Sequence[str] = (),
    rank_col: str = "rank",
    count_col: str | None = None,
    key_col: str = "shuffle_key",
    digits: int | None = None,
) -> DataFrame:
    """Rank in seeded-shuffle order (W8 + W11): key ``md5(seed:id)``, ties
    (never in practice) broken by the id. ``digits`` (of the key, per
    bucket) follows the number of rows, which is counted."""
    digits = digits or hash_digits(df.count())
    keyed = df.withColumn(key_col, shuffle_key(id_col, seed))
    return global_rank(
        keyed, [key_col, id_col], hash_bucket(key_col, digits), partition_cols, rank_col, count_col
    )


def rank_by_key(
    df: DataFrame,
    key: str,
    n_buckets: int | None = None,
    rank_col: str = "rank",
    count_col: str | None = None,
    tiebreak: str | Sequence[str] | None = None,
) -> DataFrame:
    """Rank in the natural order of a key of any sortable type (W11), nulls
    first and NaN last as Spark sorts; rows with an equal key are ordered by
    the md5 of the ``tiebreak`` columns (default: all columns, so that only
    rows equal as a whole may change places).

    Spark's range partitioning on (key, tie-break) gives the buckets: the cut
    points are sampled rows of the key's own type, and a hot key value is cut
    by its tie-break. The ranged rows are checkpointed with their bucket
    number, as another run of the sampling could choose other cuts."""
    prepare(df.sparkSession)
    columns = [tiebreak] if isinstance(tiebreak, str) else list(tiebreak or df.columns)
    tie = F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))
    if isinstance(tiebreak, str):
        tie = F.md5(F.coalesce(F.col(tiebreak).cast("string"), F.lit("")))
    n = n_buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = (
        df.withColumn("_tie", tie)
        .repartitionByRange(n, F.col(key).asc_nulls_first(), F.col("_tie"))
        .withColumn("_kb", F.spark_partition_id().cast("long"))
        .checkpoint()
    )
    return global_rank(ranged, [key, "_tie"], F.col("_kb"), (), rank_col, count_col).drop("_kb", "_tie")


def batch_assignment(
    df: DataFrame, key: str, batch_size: int, n_buckets: int | None = None, tiebreak: str | Sequence[str] | None = None
) -> DataFrame:
    """Cut the list ordered by ``key`` into consecutive groups of
    ``batch_size`` (the producer's ``grouped(n)``): ``(rank-1) div n``."""
    ranked = rank_by_key(df, key, n_buckets, tiebreak=tiebreak)
    return ranked.withColumn("batch_no", F.expr(f"(rank - 1) div {int(batch_size)}"))


def seeded_shuffle_head(df: DataFrame, id_col: str, n: int = 3, seed: int = 42) -> DataFrame:
    """Peek at the first ``n`` rows of the seeded shuffle (top-k, one
    row per task reaches the merge)."""
    keyed = df.withColumn("shuffle_key", shuffle_key(id_col, seed))
    return keyed.orderBy("shuffle_key", id_col).limit(n)


def _join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join on ``keys`` where null matches null (a null group is a group,
    as in ``PARTITION BY``); the right side's key columns are dropped. Still
    planned as a hash / sort-merge join on the keys."""
    renamed = right.select(*[F.col(c).alias(f"_rk{i}") for i, c in enumerate(keys)],
                           *[c for c in right.columns if c not in keys])
    cond = None
    for i, c in enumerate(keys):
        e = left[c].eqNullSafe(renamed[f"_rk{i}"])
        cond = e if cond is None else cond & e
    return left.join(renamed, cond, how).drop(*[f"_rk{i}" for i in range(len(keys))])


def rank_thresholds(
    df: DataFrame,
    id_col: str,
    cutoff,
    seed: int = 42,
    partition_cols: Sequence[str] = (),
    digits: int | None = None,
) -> DataFrame:
    """Per group, the (key, id) of the row whose seeded-shuffle rank equals
    ``cutoff(n)`` (``n`` = group size, a Column function), found without
    ranking every row:

    1. count rows per (group, md5-prefix bucket) -- a partial aggregation;
    2. cumulative counts over that small table locate the one bucket per
       group that holds the cutoff rank;
    3. only the rows of those boundary buckets are ranked.

    Rows with ``(key, id) <=`` their group's threshold are exactly the first
    ``cutoff(n)`` rows; groups whose cutoff is 0 get no threshold row. One
    row per group comes out."""
    parts = list(partition_cols)
    digits = digits or hash_digits(df.count())
    keys = df.select(*parts, id_col, shuffle_key(id_col, seed).alias("_k"))
    keys = keys.withColumn("_bkt", hash_bucket("_k", digits))
    counts = keys.groupBy(*parts, "_bkt").agg(F.count(F.lit(1)).alias("_bn"))
    before = Window.partitionBy(*parts).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    table = counts.withColumn("_off", F.coalesce(F.sum("_bn").over(before), F.lit(0))).withColumn(
        "_n", F.sum("_bn").over(Window.partitionBy(*parts))
    )
    table = table.withColumn("_cut", cutoff(F.col("_n")).cast("long"))
    boundary = table.where((F.col("_off") < F.col("_cut")) & (F.col("_cut") <= F.col("_off") + F.col("_bn")))
    inside = _join_null_safe(keys, boundary.select(*parts, "_bkt", "_off", "_cut"), [*parts, "_bkt"], "inner")
    w = Window.partitionBy(*parts, "_bkt").orderBy("_k", id_col)
    hit = inside.withColumn("_r", F.row_number().over(w)).where(F.col("_off") + F.col("_r") == F.col("_cut"))
    return hit.select(*parts, F.col("_k").alias("_tk"), F.col(id_col).alias("_tid"))


def first_by_rank(
    df: DataFrame,
    id_col: str,
    cutoff,
    seed: int = 42,
    partition_cols: Sequence[str] = (),
    flag: str = "_first",
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """``df`` plus a boolean ``flag``: the row is among the first
    ``cutoff(n)`` rows of its group in seeded-shuffle order.

    Every row is compared with its group's threshold (key, id). The threshold
    table has one row per group; it is computed once (checkpointed), counted,
    and broadcast up to ``BROADCAST_GROUPS`` rows, so the wide rows of ``df``
    stay where they are; a larger table is joined by a shuffle.
    ``keys_from``: a narrow table with the same ids and groups to find the
    thresholds on."""
    prepare(df.sparkSession)
    parts = list(partition_cols) or ["_all"]
    whole = (lambda d: d) if partition_cols else (lambda d: d.withColumn("_all", F.lit(0)))
    source = whole(df if keys_from is None else keys_from)
    th = rank_thresholds(source, id_col, cutoff, seed, parts).checkpoint()
    if th.count() <= BROADCAST_GROUPS:
        th = F.broadcast(th)
    joined = _join_null_safe(whole(df), th, parts, "left")
    k, tk, tid = shuffle_key(id_col, seed), F.col("_tk"), F.col("_tid")
    inside = tk.isNotNull() & ((k < tk) | ((k == tk) & F.coalesce(F.col(id_col) <= tid, F.col(id_col).isNull())))
    out = joined.withColumn(flag, F.coalesce(inside, F.lit(False))).drop("_tk", "_tid")
    return out if partition_cols else out.drop("_all")
