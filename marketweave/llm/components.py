"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from marketweave.session import shared_dir, stage


def _checksum(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """`node, component` for every node of an edge; the component is its smallest node.

    Alternates two star rewritings until nothing changes: each node's larger neighbours are
    hung on its smallest neighbour, then its smaller ones.  The number of rounds grows with
    the logarithm of the graph's size.  Every round is written to the shared folder, so a
    lost executor costs a re-read.  Nodes with many neighbours are grouped with partial
    aggregation and joined by a plain join, which Spark splits where it is skewed.
    Loops and repeated edges are ignored; no edge gives no row.
    """
    root = shared_dir(edges.sparkSession)
    now = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a > b").distinct()
    now = stage(now, "edges_0", root)
    seen, turn = _checksum(now), 0
    while seen[0]:
        turn += 1
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = stage(large, f"large_{turn}", root)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = stage(small.unionByName(least.withColumnRenamed("m", "b")).distinct(), f"edges_{turn}", root)
        before, seen = seen, _checksum(now)
        if seen == before:
            break
    leaves = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return leaves.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
