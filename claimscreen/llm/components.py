"""Connected components by alternating large and small stars, on tables only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimscreen.llm.common import forget, release, stored


def _minimum(edges: DataFrame) -> DataFrame:
    """Each node with the least of itself and its neighbours; partial minima keep hubs cheap."""
    return edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))


def _star(pairs: DataFrame) -> DataFrame:
    """Every pair with the minimum of its u's neighbourhood."""
    least = _minimum(pairs).withColumnRenamed("u", "hub")
    return pairs.join(least, F.col("u") == F.col("hub"))


def _settled(edges: DataFrame) -> bool:
    """Whether edges(u > v) are stars around their smallest node: none is u twice, or u here and v there."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("u")), F.struct(F.col("v").alias("node"), F.lit(0).alias("u")))).alias("e")).select("e.*")
    return ends.groupBy("node").agg(F.sum("u").alias("out"), F.min("u").alias("least")).filter((F.col("out") > 1) | ((F.col("out") > 0) & (F.col("least") == 0))).isEmpty()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """node, component (its smallest node) for every node of edges(a, b).

    Self-loops and repeated edges are harmless; no edges give no rows. Each
    round is one large and one small star and ends in a written table. The
    rounds end when only stars are left, which may be so from the start; they
    are O(log^2 n), and exceeding max_rounds raises instead of returning
    half-joined groups.
    """
    now = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    for _ in range(max_rounds):
        if _settled(now):
            break
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        small = _star(large)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(_minimum(large).select("u", F.col("m").alias("v")))
        before, now = now, stored(small.filter("u <> v").distinct(), "edges")
        forget(before)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = now.select(F.col("v").alias("node")).distinct()
    out = stored(now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.select("node", F.col("node").alias("component"))), "components")
    forget(now)
    release(now.sparkSession)
    return out
