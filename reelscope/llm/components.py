"""Connected components of a link table, as Spark joins.

Each round maps every node to the smallest id among itself and its
neighbours, follows that map a few steps (pointer jumping), and contracts
the links with it. Links shrink each round; the rounds grow with the
logarithm of the longest chain. Every round is written to the shared folder,
so no lineage builds up and nothing is collected.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelscope.llm.common import land

JUMPS = 2


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links`` (columns ``u``, ``v``);
    ``root`` is the smallest id of the node's component. Links may repeat,
    point either way or link a node to itself; an empty table gives none."""
    edges = land(links.select("u", "v").where("u <> v").distinct(), "links")
    steps = []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        parent = land(both.groupBy(F.col("u").alias("node"))
                      .agg(F.min("v").alias("v"))
                      .select("node", F.least("node", "v").alias("root")), "parents")
        step = parent
        for _ in range(JUMPS):
            step = _follow(step, parent)
        step = land(step, "roots")
        steps.append(step)
        ends = edges
        for c in ("u", "v"):
            other = "v" if c == "u" else "u"
            ends = (ends.join(step.withColumnRenamed("node", c), c)
                    .select(F.col("root").alias(c), other))
        edges = land(ends.where("u <> v").distinct(), "links")
    if not steps:
        return links.select(F.col("u").alias("node"), F.col("v").alias("root")).where("false")
    return reduce(_follow, steps)


def _follow(labels: DataFrame, step: DataFrame) -> DataFrame:
    """Each label replaced by what ``step`` maps it to, if anything."""
    to = step.select(F.col("node").alias("at"), F.col("root").alias("to"))
    return (labels.join(to, labels["root"] == to["at"], "left")
            .select("node", F.coalesce("to", "root").alias("root")))
