"""Connected components of an edge table by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, packed


def _min_neighbour(directed: DataFrame) -> DataFrame:
    """(u, v, m): m = the smallest of u and its neighbours.

    The minimum is a partial aggregate, so a node with very many neighbours is
    reduced before the shuffle, and its join partition can be split.
    """
    least = directed.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return directed.join(least, "u")


def components(edges: DataFrame, max_rounds: int = 60, rows: int | None = None) -> DataFrame:
    """(node, component): the smallest node that each node of ``edges`` (u, v) reaches.

    Each round links neighbours to the local minimum (large star, then small
    star); a long chain halves per round.  Rounds are checkpointed.  Null
    nodes and loops are ignored; nodes without an edge don't appear.
    ``rows``: about how many edges there are, if known; it sizes tasks only.
    """
    now = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now = cut(now if rows is None else packed(now, rows))
    mark, n = None, now.count()
    for _ in range(max_rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (_min_neighbour(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u <> v").distinct())
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        starred = _min_neighbour(down)
        now = cut(packed(starred.select(F.col("v").alias("u"), F.col("m").alias("v"))
                         .unionByName(starred.select("u", F.col("m").alias("v")))
                         .filter("u <> v").distinct(), 2 * n))
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark, n = seen, seen[0]
    else:
        raise RuntimeError("components did not settle")
    tops = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(tops)
