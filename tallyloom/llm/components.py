"""Connected components of a table of links, by rounds of joins."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.session import written


def contracted(links: DataFrame, label: str = "links") -> DataFrame:
    """Rows (node, root) for every node of ``links`` (a, b): root is the smallest node reachable.

    Large-star and small-star rounds: every node hands its neighbours to its smallest one, and
    both steps only group by one end of a link, so a round shuffles each link a few times and
    holds no group in memory. Rounds end when every node but the roots has one link, to a root,
    after about the logarithm of the longest path. Null ends and loops are ignored.
    """
    edges = written(
        links.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(),
        label,
    )
    while not _stars(edges):
        both = edges.select(F.col("hi").alias("n"), F.col("lo").alias("m")).unionByName(
            edges.select(F.col("lo").alias("n"), F.col("hi").alias("m"))
        )
        smallest = both.groupBy("n").agg(F.least(F.min("m"), F.col("n")).alias("root"))
        # Large star: neighbours above a node go to the smallest of its neighbourhood.
        large = (
            edges.withColumnRenamed("lo", "n").join(smallest, "n")
            .select(F.col("hi"), F.col("root").alias("lo")).distinct()
        )
        large = written(large, label)
        # Small star: neighbours below a node, and the node itself, go to the smallest of them.
        lowest = large.groupBy("hi").agg(F.min("lo").alias("root"))
        joined = large.join(lowest, "hi")
        small = (
            joined.where("lo <> root").select(F.col("lo").alias("hi"), F.col("root").alias("lo"))
            .unionByName(lowest.select("hi", F.col("root").alias("lo"))).distinct()
        )
        edges = written(small, label)
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(
        edges.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    )


def _stars(edges: DataFrame) -> bool:
    """Whether each node above another has no other link: a round would change nothing."""
    ends = edges.select(F.col("hi").alias("n"), F.lit(1).alias("up")).unionByName(
        edges.select(F.col("lo").alias("n"), F.lit(0).alias("up"))
    )
    held = ends.groupBy("n").agg(F.sum("up").alias("ups"), F.min("up").alias("least"))
    return held.where("ups > 1 OR (ups = 1 AND least = 0)").isEmpty()
