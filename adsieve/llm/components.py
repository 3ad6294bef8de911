"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adsieve.llm.common import broadcast_if_small, stored

ROWS = 200_000  # of a written part


def _save(df: DataFrame, rows: int, name: str) -> DataFrame:
    """Store with parts sized by the rows, so that few rows are few tasks."""
    return stored(df.coalesce(max(1, -(-rows // ROWS))), name)


def _star(edges: DataFrame, least: DataFrame, rows: int) -> DataFrame:
    """Every ``v`` of the edges moves to the minimum ``m`` of its ``u``, and each
    ``u`` once: one row a link and one an id, not two a link. ``least (u, m)`` is
    broadcast below the size bound, else stored, so that a hub's rows are split
    by the join."""
    side = broadcast_if_small(least, rows, 32)
    if side is least:
        side = least = stored(least, "stars")
    moved = edges.join(side, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def _state(edges: DataFrame) -> tuple[int, int]:
    r = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return r[0], r[1] or 0


def components(edges: DataFrame) -> DataFrame:
    """``(id, component)`` of every id that occurs in ``edges (u, v)``, its
    component's smallest id included. Each round shortens the paths; the state
    is written to the shared folder, never to the driver."""
    e = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e = stored(e, "links")
    before = _state(e)
    while before[0]:
        n = before[0]
        # large star: u's larger neighbours, and u, move to the least of u and its neighbours
        larger = e.select(F.col("v").alias("u"), F.col("u").alias("v"))
        least = e.unionByName(larger).groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = _save(_star(larger, least, 2 * n), 2 * n, "large")
        # small star: u's smaller neighbours, and u, move to the least of them
        e = _save(_star(large, large.groupBy("u").agg(F.min("v").alias("m")), 2 * n), 2 * n, "links")
        after = _state(e)
        if after == before:
            break
        before = after
    ids = e.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return ids.unionByName(e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
