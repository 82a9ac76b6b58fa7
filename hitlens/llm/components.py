"""Connected components of an edge table by alternating star contraction.

Every round is two joins on the node; its result is written below the shared
folder, so the plan stays short and a lost executor only repeats one round.
The number of rounds grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitlens.session import shared_dir


def _fingerprint(edges: DataFrame) -> tuple:
    """Order-independent digest of the edge set, for the convergence test."""
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.join(least, "u").where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` are (u, v) with u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u")
    moved = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, component) for every node with an edge; component is its smallest node.

    ``edges`` has two columns of one orderable type.  Self loops, repeated and
    reversed edges and NULLs are allowed and ignored.
    """
    u, v = (F.col(c) for c in edges.columns)
    current = (edges.where(u != v).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"))
               .distinct())
    folder, step, seen = shared_dir(spark, "components"), 0, None
    while True:
        path = f"{folder}/{step}"
        current.write.parquet(path)
        current = spark.read.parquet(path)
        now = _fingerprint(current)
        if now == seen or not now[0]:
            break
        seen, step = now, step + 1
        current = _small_star(_large_star(current))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
