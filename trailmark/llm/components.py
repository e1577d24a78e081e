"""Connected components of a link table by repeated contraction; nothing is gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stage


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for each node of ``links`` (``a``, ``b`` long).

    Each round hooks every node to its smallest neighbour, follows the hooks two steps and
    contracts the links, so that chains and stars shrink to a fraction. Tables of a round are
    written to the shared folder.
    """
    links = stage(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    nodes = stage(links.select(F.col("a").alias("node")).union(links.select("b")).distinct().withColumn("component", F.col("node")), "nodes")
    while not links.isEmpty():
        both = links.union(links.select("b", "a"))
        hooks = stage(both.groupBy(F.col("a").alias("from")).agg(F.least(F.min("b"), F.first("a")).alias("to")), "hooks")
        for _ in range(2):
            ahead = hooks.select(F.col("from").alias("to"), F.col("to").alias("next"))
            hooks = hooks.join(ahead, "to").select("from", F.col("next").alias("to"))
        hooks = stage(hooks, "hooks")
        move = lambda df, c, hooks=hooks: df.join(hooks.withColumnRenamed("from", c), c, "left").withColumn(c, F.coalesce("to", c)).drop("to")
        nodes = stage(move(nodes, "component"), "nodes")
        links = stage(move(move(links, "a"), "b").where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    return nodes
