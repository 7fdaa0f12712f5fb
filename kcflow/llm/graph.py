"""Connected components of an edge list, as Spark joins.

Each round connects every node's larger neighbours to its smallest one,
then its smaller neighbours, until all edges lead to the smallest node of
their component.  Rounds are few (about the logarithm of the longest path)
and each is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kcflow.llm.common import materialise


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of (a, b)."""
    now = materialise(_ordered(edges.select(F.col("a").alias("hi"), F.col("b").alias("lo"))),
                      "edges")
    state = _state(now)
    while True:
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
            now.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(
            F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        smallest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(smallest, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        now = materialise(_ordered(small.union(smallest.select("hi", F.col("m").alias("lo")))),
                          "small-star")
        before, state = state, _state(now)
        if state == before:
            break
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(
        now.select(F.col("lo").alias("node"), F.col("lo").alias("component"))).distinct()


def _ordered(edges: DataFrame) -> DataFrame:
    return edges.select(F.greatest("hi", "lo").alias("hi"), F.least("hi", "lo").alias("lo")) \
        .where("hi != lo").distinct()


def _state(edges: DataFrame) -> tuple:
    """A number that changes with the edge set."""
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo"))).first())
