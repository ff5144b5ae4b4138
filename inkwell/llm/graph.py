"""Connected components of a graph whose edges are a table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.sources.scratch import freeze


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for all nodes of `edges` (a, b); a component's name is its smallest node.

    Every round a node takes the smallest name around it and then the name its name has, until
    nothing changes: few rounds for the stars and short chains of near copies, and about the
    logarithm of the length for long chains. Each round is written, so a lost executor costs
    no more than a round.
    """
    both = freeze(
        edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        "edges",
    )
    names = freeze(
        both.groupBy("a").agg(F.min("b").alias("least")).select(
            F.col("a").alias("node"), F.least("a", "least").alias("name")
        ),
        "names",
    )
    while True:
        around = (
            both.join(names.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("name").alias("least"))
        )
        lower = names.join(around, "node").select(
            "node", "name", F.least("name", "least").alias("new")
        )
        jump = names.select(F.col("node").alias("new"), F.col("name").alias("beyond"))
        found = freeze(
            lower.join(jump, "new", "left").select(
                "node", F.least("new", F.coalesce("beyond", "new")).alias("new"), "name"
            ),
            "names",
        )
        names = found.select("node", F.col("new").alias("name"))
        if found.where(F.col("new") != F.col("name")).isEmpty():
            return names.withColumnRenamed("name", "component")
