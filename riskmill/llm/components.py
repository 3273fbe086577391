"""Connected components of a link table by contraction, all steps as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskmill.llm.common import materialize


def _jump(parent: DataFrame) -> DataFrame:
    """Follow parents until every node points at its root.

    Parents are never larger than their node, so there are no cycles and the number
    of rounds is the logarithm of the longest path.
    """
    while True:
        up = parent.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        step = materialize(
            parent.join(up, "parent", "left").select(
                "node",
                F.coalesce("above", "parent").alias("parent"),
                (F.coalesce("above", "parent") != F.col("parent")).alias("moved"),
            ),
            "jump",
        )
        parent = step.select("node", "parent")
        if step.filter("moved").isEmpty():
            return parent


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is its component's smallest node.

    Each round lets every node point at its smallest neighbour or itself (an aggregate
    with map-side merging), follows the pointers to roots and replaces link ends by
    roots. Links inside a component vanish, so a few rounds are enough. Intermediate
    tables are written to the shared folder and survive lost executors. Loops and
    repeated links are allowed; an empty table gives an empty table.
    """
    edges = materialize(links.select("a", "b").filter("a <> b").distinct(), "edges")
    result = None
    while True:
        ends = edges.union(edges.select("b", "a")).toDF("node", "other")
        parent = ends.groupBy("node").agg(F.min("other").alias("low"))
        parent = _jump(materialize(parent.select("node", F.least("node", "low").alias("parent")), "parent"))
        if result is None:
            result = parent.withColumnRenamed("parent", "root")
        else:
            up = parent.select(F.col("node").alias("root"), F.col("parent").alias("above"))
            joined = result.join(up, "root", "left")
            result = materialize(joined.select("node", F.coalesce("above", "root").alias("root")), "roots")
        left = parent.toDF("a", "pa")
        right = parent.toDF("b", "pb")
        contracted = edges.join(left, "a").join(right, "b").filter("pa <> pb")
        edges = materialize(contracted.select(F.col("pa").alias("a"), F.col("pb").alias("b")).distinct(), "edges")
        if edges.isEmpty():
            return result
