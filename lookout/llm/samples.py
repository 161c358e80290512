"""Bounded training samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lookout.llm.frames import col


def crc_of(id_column: Column) -> Column:
    """crc32 of the id as text (null as empty text)."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")))


def labelled_sample(
    labels: DataFrame, id_col: str, label_col: str, per_class: int, keep: Column | None = None
) -> DataFrame:
    """(id, label) with about ``per_class`` ids of each label 0 and 1 at most,
    chosen by a hash of the id, so that the sample is the same on every run.
    Null ids and labels are left out; of several labels for an id the largest
    holds. At most ``2.2 * per_class`` rows whatever the size of the table, so
    a broadcast of it is bounded."""
    rows = labels.where(col(id_col).isNotNull() & col(label_col).isNotNull())
    if keep is not None:
        rows = rows.where(keep)
    each = rows.groupBy(col(id_col).alias("id")).agg(F.max(F.least(col(label_col), F.lit(1))).cast("int").alias("label"))
    sizes = {r["label"]: r["n"] for r in each.groupBy("label").agg(F.count("*").alias("n")).collect()}
    draw = F.pmod(F.xxhash64("id", F.lit(17)), F.lit(1 << 30))
    share = F.lit(0)
    for label, n in sizes.items():
        share = F.when(F.col("label") == label, int(min(1.0, per_class / n) * (1 << 30))).otherwise(share)
    return each.where(draw < share)
