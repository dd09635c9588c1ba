"""Connected components of a link table, as repeated star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunehouse.llm.common import landed, remove


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    rest = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.unionByName(least.select("u", F.col("m").alias("v")))


def connected_components(links: DataFrame) -> DataFrame:
    """(u, v) links between bigint nodes -> (node, component), component = the smallest node reachable.

    Only linked nodes get a row. Each round is one large and one small star, written to the shared folder, so
    neither the lineage nor the number of rows grows: a round never has more rows than nodes and links. The
    number of rounds grows with the logarithm of the longest path. A hot node is combined within each task
    before the shuffle, and its join is plain, so adaptive execution may split it. Links of a node to itself,
    links with a NULL end, repeated links and both directions of a link are all allowed; no links give no rows.
    """
    spark = links.sparkSession
    ends = links.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges, path = landed(ends.distinct(), "links")

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())

    seen = mark(edges)
    while seen[0]:
        edges, newer = landed(_small_star(_large_star(edges).distinct()).distinct(), "links")
        remove(spark, path)
        path, before, seen = newer, seen, mark(edges)
        if seen == before:
            break
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
