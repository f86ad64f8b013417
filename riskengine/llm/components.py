"""Connected components of a link table by alternating star contraction, in DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskengine.llm.frames import stored


def _large_star(e: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest of the node and its neighbours."""
    both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    least = e.groupBy("a").agg(F.min("b").alias("m"))
    others = e.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.union(least.select("a", F.col("m").alias("b"))).distinct()


def _mark(e: DataFrame) -> tuple:
    row = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b: bigint); the root is the smallest node reachable.

    Both steps join a table of per-node minima, combined before the shuffle, to the links;
    a node with very many links is a skewed side that adaptive execution splits. Each round
    is written to the shared folder, so lineage stays short and a lost executor costs one round.
    """
    e = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    e = stored(e, "cc")
    seen = _mark(e)
    while seen[0]:
        e = stored(_small_star(_large_star(e)), "cc")
        now = _mark(e)
        if now == seen:
            break
        seen = now
    # At the end every link ties a node to its root.
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
