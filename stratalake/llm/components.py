"""Connected components of links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import scratch


def components(links: DataFrame, purpose: str = "components") -> DataFrame:
    """The smallest node that each node (of links u, v of one type) is connected with: node, root.

    Every round links each node's larger neighbours, then its smaller ones, to the smallest of them, until nothing moves;
    chains halve, so there are few rounds. Nodes that are in no link are not returned; null nodes and self-links are
    ignored. A neighbourhood is only reduced to its minimum and joined with it, never gathered.
    """
    edges = scratch(
        links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), purpose
    )
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # larger neighbours of u to the least node around u
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = scratch(large.where("u <> v").distinct(), purpose)
        # smaller neighbours of u, and u itself, to the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
        nearer = scratch(
            small.select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).where("u <> v").distinct(), purpose
        )
        if same_rows(edges, nearer):
            return nearer.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                nearer.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        edges = nearer


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Whether two sets of links are equal, by their number and two sums of hashes."""

    def sums(df: DataFrame) -> tuple:
        wide = [F.xxhash64(F.lit(k), "u", "v").cast("decimal(20,0)") for k in (1, 2)]
        return tuple(df.agg(F.count("*"), *(F.sum(w) for w in wide)).first())

    return sums(a) == sums(b)
