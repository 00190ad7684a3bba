"""Connected components of a table of links, by alternating star contractions."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simpairs.llm.common import cut


def components(links: DataFrame) -> DataFrame:
    """links(a, b: long) -> (node, root): root is the least node reachable; only nodes with links appear.

    Large star: each node hands its larger neighbours to the least of its neighbourhood; small star: each
    node hands itself and its smaller neighbours to the least of them. Both keep the components, and at the
    fixed point every link ends in the root. Minima are aggregated partially and joined back, so a node with very
    many links is split over tasks. Links stay in Spark; one number a round comes to the driver."""
    edges = cut(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct())
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("v").cast("decimal(38,0)")).alias("s"),
                          F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        state = (state["n"], state["s"], state["h"])
        if state == before or not state[0]:
            break
        before = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v")))).where("u != v").distinct()
        edges = cut(small)
    pairs = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return pairs.unionByName(pairs.select(F.col("root").alias("node"), "root").distinct())
