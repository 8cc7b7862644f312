"""Connected components of a graph of links, by rounds of two joins each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proofmark.llm.common import written


def connected_components(links: DataFrame, first: str = "a", second: str = "b") -> DataFrame:
    """(node, root) for every node of a link; root is the smallest node that can be reached, itself included.

    Rounds of the large-star and small-star operations: in the one, each node hands its larger neighbours the smallest
    neighbour it knows; in the other, its smaller ones. Links never grow in number, each round is written to the
    shared folder, and the state that goes to the driver is one row of sums. Ends when a round changes nothing.
    """
    edges = written(
        links.select(F.greatest(first, second).alias("u"), F.least(first, second).alias("v")).where("u <> v").distinct(), "links"
    )
    state = _sums(edges)
    while state[0]:
        edges = written(_small_star(_large_star(edges)), "links")
        new = _sums(edges)
        if new == state:
            break
        state = new
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _sums(edges: DataFrame) -> tuple:
    both = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.bit_xor(both), F.sum(both.cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """edges (u, v) with u > v: every larger neighbour of a node is tied to the node's smallest neighbour, or to itself."""
    ways = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = ways.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return ways.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """edges (u, v) with u > v: a node and its smaller neighbours are tied to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    tied = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.unionByName(least.withColumnRenamed("m", "v")).where("u <> v").distinct()
