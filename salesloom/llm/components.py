"""Connected components of a link table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.scratch import discard, materialise


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links(u, v)``; linked nodes share their root.

    Each round points every node at its smallest neighbour, replaces nodes by what they point at
    and drops links that became loops. Node ids are hashes, so the neighbours' order is random and
    each round shrinks what is left by a constant factor. A star with any number of members takes
    one round, and its centre is a grouping key with a partial minimum, never a collected list.
    """
    links = materialise(links.select("u", "v").where("u != v").distinct(), "links")
    roots = materialise(links.select(F.explode(F.array("u", "v")).alias("node")).distinct().withColumn("root", F.col("node")), "roots")
    while not links.isEmpty():
        both = links.select("u", "v").unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        old = (links, roots)
        step = materialise(both.groupBy("u").agg(F.least("u", F.min("v")).alias("to")), "step")
        roots = materialise(
            roots.join(step.withColumnRenamed("u", "root"), "root", "left").select("node", F.coalesce("to", "root").alias("root")),
            "roots",
        )
        moved = links.join(step.withColumnRenamed("to", "a"), "u").select("a", F.col("v").alias("u"))
        moved = moved.join(step.withColumnRenamed("to", "b"), "u").select(F.col("a").alias("u"), F.col("b").alias("v"))
        links = materialise(moved.where("u != v").distinct(), "links")
        for table in (*old, step):
            discard(table)
    return roots
