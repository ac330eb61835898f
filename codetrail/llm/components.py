"""Connected components of an edge table by alternating large-star and small-star steps.

Every step is a grouped minimum (combined map-side) and a join; the edge table of each round is
written to the shared folder. Only its row count and checksum reach the driver. The minima are
written before they are joined: both sides of the join are then plain shuffles, whose skewed
partitions (a node that a third of all edges share) Spark splits at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import written


def _state(edges: DataFrame) -> tuple[int, int]:
    """Row count and checksum (the sum is exact: a decimal does not wrap)."""
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return r[0], int(r[1] or 0)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "cc-least")
    out = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.where("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = written(down.groupBy("u").agg(F.min("v").alias("m")), "cc-least")
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges(u, v)`` -> ``(u, v)``: every node that is not the least of its component, with the least.

    Null ends and loops are ignored; nodes without an edge do not appear.
    """
    now = written(edges.where("u is not null and v is not null and u != v").select("u", "v").distinct(), "cc-edges")
    state = _state(now)
    while state[0]:
        now = written(_small_star(_large_star(now)), "cc-round")
        state, before = _state(now), state
        if state == before:
            break
    return now
