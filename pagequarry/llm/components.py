"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagequarry.llm.common import stage


def components(edges: DataFrame) -> DataFrame:
    """``(id, component)`` of every end of ``edges(a, b)``: the smallest id
    that links lead to.

    Rounds of large and small stars: every vertex hooks its neighbours to the
    smallest one it knows, so the number of rounds grows with the logarithm of
    the diameter. A round moves edges only, its minima are combined before the
    shuffle, and it is written to the shared folder. Nulls and loops are dropped.
    """
    a, b = F.col("a"), F.col("b")
    held = stage(edges.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "edges")
    before = None
    while True:
        mark = held.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if mark == before:
            break
        before = mark
        held = stage(_small(_large(held)), "edges")
    # Every edge now leads from a vertex to the smallest of its component.
    return held.select(a.alias("id"), b.alias("component")).union(held.select(b, b)).distinct()


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    hooked = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hooked.where("a != b").distinct()


def _small(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    hooked = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")
    return hooked.union(least.select("a", F.col("m").alias("b"))).distinct()
