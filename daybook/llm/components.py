"""Connected components of an undirected graph by alternating large and small stars.

Each round hangs every node's neighbours on the smallest node it sees; the rounds needed grow with the logarithm of
the longest path. Degrees may be anything: minima are pre-aggregated, and the joins are plain equi-joins that adaptive
execution can split. Every round is written to the shared folder, so that a lost executor costs that round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.scratch import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    hung = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node either hangs on one other node or has only nodes hanging on it."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("hangs")).unionAll(edges.select(F.col("v").alias("x"), F.lit(0).alias("hangs")))
    seen = ends.groupBy("x").agg(F.sum("hangs").alias("n"), F.min("hangs").alias("least"))
    return seen.where("n > 1 or (n > 0 and least = 0)").limit(1).count() == 0


def components(edges: DataFrame, scratch: Scratch, name: str = "star") -> DataFrame:
    """(node, root): every node of an edge with the smallest node of its component. edges: (u, v) of a sortable type."""
    now, k = scratch.save(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), f"{name}-0"), 0
    while not _are_stars(now):
        k += 1
        now = scratch.save(_small_star(_large_star(now)), f"{name}-{k}")
        scratch.drop(f"{name}-{k - 1}")
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(roots)
