"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.blocks import hand_off


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.join(least, "u")
    rest = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(u, v)`` links to ``(node, component)``: every linked node with the least node it reaches.

    Nodes without links have no row. Null ends and self links are left out. Each round hands its
    edges on as a table in the shared folder, so nothing is recomputed and no link meets the driver.
    """
    current = hand_off(edges.select("u", "v").where("u <> v").distinct(), "edges")
    before = None
    while True:
        count, sign = current.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if not count or (count, sign) == before:
            return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                current.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
        before = (count, sign)
        current = hand_off(_small_star(_large_star(current)), "edges")
