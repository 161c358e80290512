"""Connected components of an edge table by alternating large and small stars.

Only minima per node are grouped (combined before the shuffle), so a node
with very many neighbours is never gathered; joins on such a node are split
by adaptive execution. Each round is cut off with ``checkpoint()``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


# Edges in a task of a round: rounds over few edges need few tasks.
TASK_EDGES = 100_000


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v) of any sortable type -> (node, comp): for each node
    with an edge, the smallest node that it is connected to. Loops and
    repeated edges don't matter; an empty table gives an empty table."""
    e = (
        edges.where("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
        .checkpoint()
    )
    before = _state(e)
    while before[0]:
        tasks = 4 + before[0] // TASK_EDGES
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).coalesce(tasks)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .coalesce(tasks)
            .distinct()
        )
        e = small.coalesce(tasks).checkpoint()
        after = _state(e)
        if after == before:
            break
        before = after
    own = e.select(F.col("u").alias("node"), F.col("v").alias("comp"))
    return own.unionByName(own.select(F.col("comp").alias("node"), "comp").distinct())
