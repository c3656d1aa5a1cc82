"""Connected components of a graph by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold.operators.skew import LIMITS, Limits, hot_hashes, key_hash
from starfold.sources import stage, stored_rows


def _with_least(edges: DataFrame, least: DataFrame, limits: Limits, rows: int) -> DataFrame:
    """Edges (u, v) with the least m of their u; nodes of very many edges, 2048 at most, meet theirs by broadcast."""
    hot = hot_hashes(edges, {"u": ["u"]}, limits, rows=rows)["u"]
    if not hot:
        return edges.join(least, "u")
    is_hot = key_hash([F.col("u")]).isin(hot)
    return edges.filter(~is_hot).join(least.filter(~is_hot), "u").unionByName(edges.filter(is_hot).join(F.broadcast(least.filter(is_hot)), "u"))


def components(edges: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """(node, root) for edges (a, b) of longs; the root is the least node reachable.

    Each round links neighbours to the least of them, larger ones first, then
    smaller ones, until every node points at its root. Only minima are aggregated,
    so a node with many neighbours costs one row per task there, and its edges
    stay in the tasks that have them when the minimum comes back. Rounds are stored, so
    lineage stays short and lost executors cost one round at most.
    """
    now = stage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "components")
    state = None
    while True:
        both = now.filter("u <> v").unionByName(now.filter("u <> v").select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        rows = stored_rows(now)
        large = _with_least(both.filter("v > u"), least, limits, rows).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        if rows >= limits.hot_rows:
            large = stage(large, "components")
        floor = large.groupBy("u").agg(F.min("v").alias("m"))
        met = _with_least(large, floor, limits, rows)
        small = met.select(F.col("u"), F.col("m").alias("v")).unionByName(
            met.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        now = stage(small.distinct(), "components")
        last, state = state, now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == last:
            nodes = now.groupBy("u").agg(F.min("v").alias("v"))
            loops = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
            found = loops.join(nodes, F.col("node") == F.col("u"), "left")
            return found.select("node", F.coalesce("v", "node").alias("root"))
