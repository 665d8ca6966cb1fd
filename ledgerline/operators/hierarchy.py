"""Hierarchies as (child, parent) links: the closure table and sums along it."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.session import ensure_checkpoint_dir


def closure(links: DataFrame, child: str, parent: str) -> DataFrame:
    """(Ancestor, Descendant, Distance): every node with itself and all above it; Distance is the shortest.

    Pointer doubling: a round joins ancestors known so far with their own ancestors, so the
    rounds grow with the logarithm of the depth.  A cycle raises ValueError.  Links without a
    parent name a node; repeated ones count once.
    """
    ensure_checkpoint_dir(links.sparkSession)
    pairs = links.select(F.col(child).alias("_c"), F.col(parent).alias("_p")).where(F.col("_c").isNotNull())
    steps = pairs.where(F.col("_p").isNotNull()).select(F.col("_p").alias("Ancestor"), F.col("_c").alias("Descendant")) \
        .distinct().withColumn("Distance", F.lit(1).cast("bigint")).checkpoint()
    nodes = pairs.select(F.explode(F.array("_c", "_p")).alias("Descendant")).where(F.col("Descendant").isNotNull()) \
        .distinct().checkpoint()
    rounds = math.ceil(math.log2(max(2, nodes.count()))) + 1
    known, size = steps, steps.count()
    for _ in range(rounds):
        upper = known.select(F.col("Descendant").alias("_at"), F.col("Ancestor").alias("_above"), F.col("Distance").alias("_more"))
        longer = known.join(upper, F.col("Ancestor") == F.col("_at")).select(
            F.col("_above").alias("Ancestor"), "Descendant", (F.col("Distance") + F.col("_more")).alias("Distance"))
        known = known.unionByName(longer).groupBy("Ancestor", "Descendant").agg(F.min("Distance").alias("Distance")).checkpoint()
        if not known.where(F.col("Ancestor") == F.col("Descendant")).isEmpty():
            raise ValueError("the hierarchy holds a cycle")
        grown = known.count()
        if grown == size:
            break
        size = grown
    own = nodes.select(F.col("Descendant").alias("Ancestor"), "Descendant", F.lit(0).cast("bigint").alias("Distance"))
    return own.unionByName(known)


def sums_along(values: DataFrame, tree: DataFrame, node: str, keys: list[str], sums: list[str]) -> DataFrame:
    """Sums of each node and all below it, per ``keys``; a node outside the tree counts for itself.

    ``values`` are summed per node before they meet their ancestors.
    """
    per_node = values.groupBy(node, *keys).agg(*[F.sum(s).alias(s) for s in sums])
    up = tree.select(F.col("Descendant").alias("_below"), F.col("Ancestor").alias("_above"))
    joined = per_node.join(up, F.col(node) == F.col("_below"), "left")
    return joined.groupBy(F.coalesce("_above", node).alias(node), *keys).agg(*[F.sum(s).alias(s) for s in sums])
