"""Connected components by alternating large-star and small-star steps.

Each step is one partially aggregated minimum and one join; the edges of every step are written
to the shared folder, so a lost executor repeats one step at most. Paths shrink by half per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import remove, scratch


def _step(edges: DataFrame, large: bool) -> DataFrame:
    """large: every larger neighbour of u is tied to u's least neighbour (or u itself);
    small: u and its smaller neighbours are tied to the least of them."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if not large:
        both = edges  # u > v holds: the smaller neighbours of u
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    tied = both.join(least, "u")
    if large:
        out = tied.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = tied.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return out.filter(F.col("u") > F.col("v")).distinct()


def connected_components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v: two ids, any order), the root being the
    least id of its component. Loops and repeated edges are allowed."""
    spark = edges.sparkSession
    path = scratch(spark, "components")
    edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v").distinct() \
        .write.parquet(path)
    current, state = spark.read.parquet(path), None
    for _ in range(rounds):
        for large in (True, False):
            new = scratch(spark, "components")
            _step(current, large).write.parquet(new)
            remove(spark, path)
            path, current = new, spark.read.parquet(new)
        seen = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state:
            break
        state = seen
    else:
        raise RuntimeError(f"components did not settle within {rounds} rounds")
    # At rest every edge leads to its component's least node.
    roots = current.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
