"""Connected components of a large edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.session import scratch_path


def _written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write to shared storage and read back: the lineage ends here and survives lost executors."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour (or itself)."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    return (down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionAll(least.select("u", F.col("m").alias("v"))).where("u != v").distinct())


def _all_stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one smaller node that itself hangs on none."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("hangs")),
                                          F.struct(F.col("v").alias("node"), F.lit(0).alias("hangs")))).alias("end"))
    nodes = ends.groupBy("end.node").agg(F.sum("end.hangs").alias("hangs"), F.min("end.hangs").alias("least"))
    return nodes.where("hangs > 1 OR hangs > 0 AND least = 0").isEmpty()


def connected_components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``node, component`` (smallest node reachable) of every node that has an edge.

    ``edges`` has long columns ``u`` and ``v``; loops, repeats and either
    direction are fine, nulls are ignored.  Each round is two partial
    aggregations and two joins, written to shared storage, until only stars are
    left (edges that are stars already need no round); the number of rounds is
    logarithmic in the size of a component.  A hot centre is one key of a join
    that adaptive execution may split, never one task's group.
    """
    now = _written(spark, edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                   .distinct(), "components")
    while not _all_stars(now):
        now = _written(spark, _small_star(_large_star(now)), "components")
    # every edge points at the component's smallest node
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
