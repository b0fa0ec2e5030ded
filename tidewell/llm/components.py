"""Connected components of an edge table, by alternating large-star and small-star steps.

Each step is a grouped minimum (combined before the shuffle) and an equi-join. Steps are written to the shared
folder, so lineage stays short and a lost executor costs one step. Nothing but two numbers a round
reaches the driver.
"""

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidewell.scratch import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    others = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionByName(least.select("u", F.col("m").alias("v")))


def _stored(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges written and read back, and their number and digest as the write saw them."""
    seen = Observation("edges")
    counted = edges.observe(seen, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("digest"))
    now = stored(counted, "components")
    return now, (seen.get["n"], seen.get["digest"])


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v) but the roots themselves; a root is the smallest
    node reachable. Loops, repeated edges and either direction are allowed."""
    ordered = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now, state = _stored(ordered.where("u <> v").distinct())
    while state[0]:
        before = state
        now, state = _stored(_small_star(_large_star(now).distinct()).distinct())
        if state == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
