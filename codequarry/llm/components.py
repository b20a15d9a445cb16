"""Connected components of a link table, by rounds of joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def connected_components(links: DataFrame, max_rounds: int = 64) -> DataFrame:
    """``node, component``: the smallest node that each node of ``a, b`` can reach.

    Alternates two steps until nothing changes: every node links all its larger neighbours to the
    smallest one it sees, then its smaller neighbours too.  Both are one aggregation and one join, and
    rows never outnumber the links.  Raises if ``max_rounds`` were not enough.
    """
    spark = links.sparkSession
    edges = materialize(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct(), "links"
    )
    if edges.isEmpty():
        return spark.createDataFrame([], "node long, component long")
    signature = None
    for _ in range(max_rounds):
        # Large star: each node hands the smallest of itself and its neighbours to its larger neighbours.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("least"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        large = materialize(large.distinct(), "large-star")
        # Small star: each node links its smaller neighbours and itself to the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("least"))
        down = large.join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v")).filter("u > v")
        edges = materialize(down.unionByName(least.withColumnRenamed("least", "v")).distinct(), "small-star")
        found = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if found == signature:
            roots = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
        signature = found
    raise RuntimeError(f"components did not settle within {max_rounds} rounds")
