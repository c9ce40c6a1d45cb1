"""Connected components as DataFrame rounds of large-star and small-star (Kiveris et al., 2014).

Every round is cut by a reliable checkpoint; only a count and a checksum reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.state import cut, few


def _lowest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (both.join(_lowest(both), "u").where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = _lowest(down)
    linked = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges(u, v)``; root is the smallest node reachable.

    Null ends and self loops are ignored; no edges give no rows.
    """
    now = cut(edges.select("u", "v").where("u is not null and v is not null and u <> v").distinct())
    rows, seen = now.count(), None
    for _ in range(max_rounds):
        now = cut(few(_small_star(few(_large_star(few(now, rows)), rows)), rows))
        mark = now.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        rows = mark[0]
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError(f"components: not settled after {max_rounds} rounds")
    return (now.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .union(now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct())
