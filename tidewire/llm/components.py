"""Connected components of a distributed edge list (alternating large and small stars)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, staged


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Columns node, root (least node reachable) for every node of ``edges`` (a, b) that is not its own root.

    Minima are pre-aggregated before they are shuffled, and hubs meet their
    neighbours in a join that adaptive execution can split, so one giant
    component is no hot task. Rounds grow with the logarithm of the nodes. Self
    edges and repeated edges are allowed; null ends are dropped.
    """
    now = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = _state(now)
    for _ in range(most_rounds):
        if not seen[0]:
            break
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = staged(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        last, now = now, staged(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
        discard(last)
        discard(large)
        before, seen = seen, _state(now)
        if seen == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
