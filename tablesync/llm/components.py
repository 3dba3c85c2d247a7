"""Connected components of a graph of long ids, by alternating large and small stars.

Each round only takes minima per node and joins them back, so a hub with any number of edges is
pre-aggregated before it is shuffled and split by the skew handling of the join. Rounds are cut with
checkpoints in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import checkpointed


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.where(F.col("u") > F.col("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, label`` of every node that has an edge to another; the label is the smallest node.

    Edges with a null end, loops and repeated edges are allowed; the first two are left out.
    """
    spec = [F.greatest(a, b).alias("u"), F.least(a, b).alias("v")]
    now = checkpointed(
        edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).select(*spec).distinct()
    )
    state = None
    while True:
        mark = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("mark")
        new = now.agg(F.count(F.lit(1)).alias("n"), mark).first()
        if new == state:
            break
        state = new
        now = checkpointed(_small_star(_large_star(now)).distinct())
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).union(roots)
