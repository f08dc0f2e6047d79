"""Connected components of a table of links, by alternating large-star and small-star rounds.

Each round replaces the links of a node by links to its smallest neighbour; both rounds are a grouping and a
join, so no node's neighbours are ever collected. The links of every round are written to the shared folder,
which cuts the lineage, and the rounds end when they stay the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo")), F.sum(F.pmod(F.xxhash64("lo", "hi"), F.lit(1 << 30)))).first())


def connected_components(links: DataFrame, rounds: int = 100) -> DataFrame:
    """``node``, ``component`` (the smallest node reachable) for every node that is not the smallest of its own.

    ``links``: two long columns, any names, any direction, repeats allowed; links to itself and nulls are ignored.
    Rounds grow with the logarithm of the longest chain; links that still change after ``rounds`` raise an error.
    """
    a, b = (F.col(c) for c in links.columns)
    links = stored(links.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).filter(a.isNotNull() & b.isNotNull() & (a != b)).distinct(), "links")
    before = _state(links)
    if not before[0]:
        return links.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    for _ in range(rounds):
        both = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(links.select("lo", "hi"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        lowest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(lowest, "hi").select(
            F.explode(F.array(F.struct("hi", F.col("m").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("x"))
        links = stored(small.select("x.hi", "x.lo").filter("hi <> lo").distinct(), "links")
        now = _state(links)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components still change after {rounds} rounds")
    return links.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
