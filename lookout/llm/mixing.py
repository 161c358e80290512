"""Mixing sources to target weights by hierarchical budgeting (operator 5).

DataFrame functions only. Rows are the leaves' documents of a tree (domain,
language, source or any other list of columns), with whole-number weights for
the nodes of each level.

*Budgets.* A node can give its tokens ``max_epochs`` times. From the root
down, a node's budget is divided among its children by weight; a child that
can't give its share gives all it has, and what is missing is divided among
its siblings again, by weight, until it fits. A node's own capacity is that of
everything below it, so a shortage reaches the ancestors only when no sibling
can take it. With the children sorted by capacity per weight, the children
that are exhausted are a prefix, so one window over the (few) nodes finds
them; the arithmetic is in whole numbers.

*Selection.* Epoch e of a leaf is its documents in the order of
``md5(seed:e:id)``. A leaf gives whole epochs first, then the longest prefix
of the next epoch that fits what is left. The end of a prefix is found without
sorting a leaf: tokens are summed by leading hex digits of the order (about
the square root of the leaf's documents per digit group), running sums over
the groups name the one group in which the prefix ends, and only that group is
sorted. Documents then compare their own key with their leaf's last one.

The leaf table is joined by broadcast up to ``BROADCAST_LEAVES`` rows and by
an ordinary join beyond.

Defined cases: null node names are nodes like any other; null token counts
and texts count 0; weights of 0 or less give a node nothing; rows with equal
ids (and null ids) share a key and are taken or left together; a leaf without
tokens gives nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lookout.llm.frames import OWN, col, prepare, whole_text

BROADCAST_LEAVES = 50_000
MAX_EPOCHS = 4
WORD = r"[^\x20\x09-\x0D]+"
WHOLE = "decimal(38,0)"


def word_count(text_col: str) -> Column:
    return F.regexp_count(whole_text(text_col), F.lit(WORD)).cast("long")


def _with_root_budget(nodes: DataFrame, budget: int | None) -> DataFrame:
    """``nodes`` with the root's budget: sums of each task, then a row for all."""
    wanted = F.sum("tokens") if budget is None else F.lit(budget)
    root = nodes.agg(F.least(F.sum(OWN + "cap"), wanted.cast(WHOLE)).cast(WHOLE).alias(OWN + "b"))
    return nodes.crossJoin(F.broadcast(root))


def leaf_budgets(
    leaves: DataFrame, levels: Sequence[str], weights: Sequence[Column], budget: int | None, max_epochs: int = MAX_EPOCHS
) -> DataFrame:
    """``leaves``: the level columns, ``tokens`` and ``docs``. Adds
    ``budget``, the whole number of tokens to take from the leaf. ``budget``
    None: as many as there are."""
    weight = [f"{OWN}w{i}" for i in range(len(levels))]
    nodes = leaves.withColumns(
        {w: F.greatest(F.lit(0), F.coalesce(e.cast("long"), F.lit(0))) for w, e in zip(weight, weights, strict=True)}
    )
    # A leaf under a node of weight 0 can't be reached.
    reached = F.lit(True)
    for w in weight:
        reached = reached & (F.col(w) > 0)
    nodes = nodes.withColumn(OWN + "cap", F.when(reached, F.col("tokens") * max_epochs).otherwise(0).cast(WHOLE))
    nodes = _with_root_budget(nodes, budget)
    for i, level in enumerate(levels):
        above, here = list(levels[:i]), list(levels[: i + 1])
        b, w, cap, cap_before, w_left, all_of_it = (OWN + c for c in ("xb", "xw", "xcap", "xcb", "xwl", "xall"))
        grouped = nodes.groupBy(*here).agg(
            F.max(OWN + "b").alias(b), F.max(weight[i]).cast(WHOLE).alias(w), F.sum(OWN + "cap").cast(WHOLE).alias(cap)
        )
        siblings = W.partitionBy(*above) if above else W.partitionBy(F.lit(0))
        run = siblings.orderBy(F.try_divide(F.col(cap).cast("double"), w).asc_nulls_first(), F.col(level).asc_nulls_first())
        before = run.rowsBetween(W.unboundedPreceding, -1)
        zero = F.lit(0).cast(WHOLE)
        out_cap = F.coalesce(F.sum(F.when(F.col(all_of_it), F.col(cap))).over(siblings), zero).cast(WHOLE)
        in_w = F.coalesce(F.sum(F.when(~F.col(all_of_it), F.col(w))).over(siblings), zero).cast(WHOLE)
        shared = (
            grouped.withColumn(cap_before, F.coalesce(F.sum(cap).over(before), zero).cast(WHOLE))
            .withColumn(w_left, (F.sum(w).over(siblings) - F.coalesce(F.sum(w).over(before), zero)).cast(WHOLE))
            .withColumn(all_of_it, F.expr(f"({cap_before} * {w} + {cap} * {w_left}) <= {b} * {w}"))
            .withColumns({cap_before: out_cap, w_left: in_w})
            .select(
                *[F.col(c).alias(f"{OWN}{j}") for j, c in enumerate(here)],
                F.when(F.col(all_of_it), F.col(cap))
                .otherwise(F.expr(f"cast((({b} - {cap_before}) * {w}) div nullif({w_left}, 0) as {WHOLE})"))
                .alias(OWN + "nb"),
            )
        )
        on = F.lit(True)
        for j, c in enumerate(here):
            on = on & nodes[c].eqNullSafe(shared[f"{OWN}{j}"])
        nodes = nodes.join(shared, on, "left").select(
            *[nodes[c] for c in leaves.columns],
            *weight,
            OWN + "cap",
            F.coalesce(OWN + "nb", F.lit(0)).cast(WHOLE).alias(OWN + "b"),
        ).checkpoint()
    return nodes.select(*leaves.columns, F.col(OWN + "b").cast("long").alias("budget"))


def _with_leaf(rows: DataFrame, leaf: DataFrame, names: Sequence[str], n_leaves: int, more: Sequence[str]) -> DataFrame:
    """``rows`` with the columns ``more`` of their leaf (rows without one go)."""
    right = leaf.select(*[F.col(c).alias(f"{OWN}k{i}") for i, c in enumerate(names)], *more)
    if n_leaves <= BROADCAST_LEAVES:
        right = F.broadcast(right)
    on = F.lit(True)
    for i, c in enumerate(names):
        on = on & rows[c].eqNullSafe(F.col(f"{OWN}k{i}"))
    return rows.join(right, on).drop(*[f"{OWN}k{i}" for i in range(len(names))])


def mix(
    df: DataFrame,
    id_col: str,
    tokens: Column,
    levels: dict[str, tuple[Column, Column]],
    budget: int | None = None,
    max_epochs: int = MAX_EPOCHS,
    seed: int = 42,
) -> DataFrame:
    """Rows of ``df``, each as often as it is taken, with ``epoch`` (from 0).
    ``levels``: for every level from the root, its name, the node that a row
    belongs to, and the node's weight (over columns named as the levels)."""
    prepare(df.sparkSession)
    names = [OWN + n for n in levels]
    node = {OWN + n: e for n, (e, _) in levels.items()}
    ident, n, full, rest, digits, key, part, edge, before, last = (
        OWN + c for c in ("id", "n", "full", "rest", "digits", "key", "part", "edge", "before", "last")
    )
    rows = (
        df.withColumns(node)
        .select(*names, col(id_col).alias(ident), F.coalesce(tokens, F.lit(0)).cast("long").alias(n))
        .checkpoint()  # tokens are counted once; narrow rows
    )
    leaves = (
        rows.groupBy(*[F.col(OWN + level).alias(level) for level in levels])
        .agg(F.sum(n).alias("tokens"), F.count("*").alias("docs"))
        .checkpoint()
    )
    planned = leaf_budgets(leaves, list(levels), [w for _, w in levels.values()], budget, max_epochs)
    leaf = (
        planned.select(
            *[F.col(level).alias(OWN + level) for level in levels],
            F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(0).cast("long").alias(full),
            (F.col("budget") - F.when(F.col("tokens") > 0, F.expr("(budget div tokens) * tokens")).otherwise(0)).alias(rest),
            F.greatest(F.lit(1), F.ceil(F.log2("docs") / 8)).cast("int").alias(digits),
        )
    ).checkpoint()
    n_leaves = leaf.count()

    def keyed(frame: DataFrame, id_name: str, from_leaf: DataFrame, more: Sequence[str] = ()) -> DataFrame:
        text = F.concat(
            F.lit(f"{seed}:"), F.col(full).cast("string"), F.lit(":"), F.coalesce(col(id_name).cast("string"), F.lit(""))
        )
        return (
            _with_leaf(frame, from_leaf, names, n_leaves, [full, rest, digits, *more])
            .withColumn(key, F.md5(text))
            .withColumn(part, F.expr(f"substring({key}, 1, {digits})"))
        )

    placed = keyed(rows, ident, leaf).where(F.col(rest) > 0)
    sums = placed.groupBy(*names, rest, part).agg(F.sum(n).alias(n))
    upto = W.partitionBy(*names).orderBy(part).rowsBetween(W.unboundedPreceding, 0)
    edges = (
        sums.withColumn("upto", F.sum(n).over(upto))
        .where(F.col("upto") > F.col(rest))
        .groupBy(*names)
        .agg(F.min(F.struct(F.col(part).alias("p"), (F.col("upto") - F.col(n)).alias("b"))).alias("e"))
        .select(*names, F.col("e.p").alias(edge), F.col("e.b").alias(before))
        .checkpoint()
    )
    inside = _with_leaf(placed, edges, names, n_leaves, [edge, before]).where(F.col(part) == F.col(edge))
    run = W.partitionBy(*names).orderBy(key).rowsBetween(W.unboundedPreceding, 0)
    ends = (
        inside.groupBy(*names, edge, before, rest, key)
        .agg(F.sum(n).alias(n))
        .withColumn("upto", F.col(before) + F.sum(n).over(run))
        .groupBy(*names, edge)
        .agg(F.max(F.when(F.col("upto") <= F.col(rest), F.col(key))).alias(last))
        # Where nothing of the group fits, the prefix ends before its first key.
        .select(*[F.col(c).alias(c + "_") for c in names], F.coalesce(last, edge).alias(last))
    )
    on = F.lit(True)
    for c in names:
        on = on & F.col(c).eqNullSafe(F.col(c + "_"))
    complete = leaf.join(ends, on, "left").select(*leaf.columns, last).checkpoint()
    chosen = keyed(df.withColumns(node), id_col, complete, [last])
    in_prefix = (F.col(rest) > 0) & F.coalesce(F.col(key) <= F.col(last), F.lit(False))
    copies = (F.col(full) + F.when(in_prefix, 1).otherwise(0)).cast("int")
    return (
        chosen.withColumn(OWN + "copies", copies)
        .where(F.col(OWN + "copies") > 0)
        .select(
            *[col(c) for c in df.columns if c != "epoch"],
            F.explode(F.sequence(F.lit(0), F.col(OWN + "copies") - 1)).alias("epoch"),
        )
    )
