"""Connected components of an edge table by alternating stars, each round cut off by a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import apart, written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """node and component (its least node) for the edges (u, v), two columns of longs.

    Neighbours are only ever reduced to their minimum, which is combined before the shuffle; the joins back are on a key
    that is unique on one side, so a hub's rows can be split. Nodes without an edge to another one are left out.
    """
    now = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = _state(now)
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(apart(least), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        pairs = F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")
        small = large.join(apart(least), "u").select(pairs).select("x.u", "x.v").where("u <> v").distinct()
        now, before = written(small, "edges"), state
        state = _state(now)
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
