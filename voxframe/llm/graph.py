"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import remove, staged

SALTS = 16


def _written(edges: DataFrame) -> tuple[DataFrame, tuple[int, int]]:
    """The edges as a written table, and their number and a hash of them, observed while they are written."""
    seen = Observation()
    held = staged(edges.observe(seen, F.count("*").alias("n"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0)).alias("h")), "cc")
    return held, (seen.get["n"], seen.get["h"])


def _with_least(rows: DataFrame, salts: int, own: bool) -> DataFrame:
    """Edges (u, v) with m, the least v of their u, or u itself with `own`. A u with very many edges is dealt by a hash of v."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("v", F.lit(11)), F.lit(salts)))
    part = salted.groupBy("u", "salt").agg(F.min("v").alias("m"))
    least = part.groupBy("u").agg(F.min("m").alias("m"))
    least = least.select("u", (F.least("u", "m") if own else F.col("m")).alias("m"))
    return salted.join(part.select("u", "salt").join(least, "u"), ["u", "salt"]).select("u", "v", "m")


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Rows (node, root): root is the smallest node that can be reached. `edges` has long columns a and b.

    Every round moves rows through hash aggregates and joins only, and ends in a written table, so a lost
    executor repeats one round at most. Nodes without an edge to another node are not returned.
    """
    spark = edges.sparkSession
    held, before = _written(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    for _ in range(rounds):
        if before[0] == 0:
            break
        both = held.union(held.select("v", "u"))
        large = _with_least(both, SALTS, True).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _with_least(large, SALTS, False)
        # a node points to its least neighbour, and so do its other neighbours
        after, state = _written(small.select(F.when(F.col("v") != F.col("m"), F.col("v")).otherwise(F.col("u")).alias("u"), F.col("m").alias("v")).distinct())
        remove(spark, held)
        held = after
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components have not settled after {rounds} rounds")
    return held.select(F.col("u").alias("node"), F.col("v").alias("root"))
