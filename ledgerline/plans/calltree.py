"""Call tree from (ExecutionGUID, ParentExecutionGUID) pairs, by pointer doubling.

Every node starts with its parent as the top of its path.  A round joins each open path with
the paths of its top, which doubles its length, so a tree of depth d takes about log2(d) rounds, not d
levels.  Paths whose top is a root are done.  The planner picks each round's join by size; AQE
splits a top with very many paths below it.  Every round is checkpointed in the session's shared
checkpoint folder, which cuts lineage and survives the loss of executors.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline import constants as K
from ledgerline.session import ensure_checkpoint_dir

CYCLE = "the call tree holds a cycle"


def _refuse_cycle(known: DataFrame, roots: DataFrame) -> None:
    """Raises ValueError if a root reaches a cycle; on pairs (node, top) alone, whose number has a bound.

    Needed only where nodes have several parents: the number of paths on a cycle may grow without bound there.
    """
    links = known.select(F.col("node").alias("Descendant"), F.col("parent").alias("Ancestor")).distinct().checkpoint()
    reach = links
    size = reach.count()
    while True:
        upper = reach.select(F.col("Descendant").alias("_at"), F.col("Ancestor").alias("_above"))
        longer = reach.join(upper, F.col("Ancestor") == F.col("_at")).select("Descendant", F.col("_above").alias("Ancestor"))
        reach = reach.unionByName(longer).distinct().checkpoint()
        grown = reach.count()
        if grown == size:
            break
        size = grown
    on_cycle = reach.where(F.col("Ancestor") == F.col("Descendant")).select("Descendant")
    under_root = reach.join(roots.select(F.col("node").alias("Ancestor")).distinct(), "Ancestor").select("Descendant")
    if not on_cycle.join(under_root, "Descendant", "left_semi").isEmpty():
        raise ValueError(CYCLE)


def call_tree(edges: DataFrame, node: str = "ExecutionGUID", parent: str = "ParentExecutionGUID") -> DataFrame:
    """(node, parent, depth, root, path) for every node reachable from a root.

    A root has no parent or a parent that is not itself a node.  Repeated
    (node, parent) pairs are collapsed first; a node with several parents has a row for each
    path.  A cycle that a root reaches raises ValueError; one that none reaches is left out.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    e = edges.select(F.col(node).alias("node"), F.col(parent).alias("parent")) \
        .where(F.col("node").isNotNull()).distinct().checkpoint()
    nodes = e.select(F.col("node").alias("parent")).distinct()
    known = e.where(F.col("parent").isNotNull()).join(nodes, "parent", "left_semi")
    roots = e.where(F.col("parent").isNull()).unionByName(
        e.where(F.col("parent").isNotNull()).join(nodes, "parent", "left_anti"))
    n, most_parents = e.groupBy("node").agg(F.count(F.lit(1)).alias("n")).agg(F.count(F.lit(1)), F.max("n")).first()
    if n and most_parents > 1:
        _refuse_cycle(known, roots)
    finished = [roots.select("node", "parent", F.col("node").alias("top"), F.lit(0).alias("depth"),
                             F.col("node").alias("path")).checkpoint()]
    # An open path names the nodes below its top.
    waiting = known.select("node", "parent", F.col("parent").alias("top"), F.lit(1).alias("depth"), F.col("node").alias("path"))
    for _ in range(math.ceil(math.log2(max(2, n))) + 1):
        if waiting.isEmpty():
            break
        above = waiting.withColumn("done", F.lit(False))
        for f in finished:
            above = above.unionByName(f.withColumn("done", F.lit(True)))
        above = above.select(F.col("node").alias("_node"), F.col("top").alias("_top"), F.col("depth").alias("_depth"),
                             F.col("path").alias("_path"), "done")
        longer = waiting.join(above, F.col("top") == F.col("_node")).select(
            "node", "parent", F.col("_top").alias("top"), (F.col("depth") + F.col("_depth")).alias("depth"),
            F.concat_ws(K.CALL_STACK_JOINER, "_path", "path").alias("path"), "done").checkpoint()
        finished.append(longer.where("done").drop("done"))
        waiting = longer.where("NOT done").drop("done")
    else:
        # Open after more steps than there are nodes: a cycle, rooted if its top is.
        reached = finished[0].select(F.col("node").alias("top"))
        for f in finished[1:]:
            reached = reached.unionByName(f.select(F.col("node").alias("top")))
        if not waiting.join(reached.distinct(), "top", "left_semi").isEmpty():
            raise ValueError(CYCLE)
    out = finished[0]
    for f in finished[1:]:
        out = out.unionByName(f)
    return out.select("node", "parent", "depth", F.col("top").alias("root"), "path")
