"""Window state carried from batch to batch.

A batch leaves one row per key it touched: the key's newest window ``(key,
anchor_us, n)``. The next batch lays these windows under its own events as
synthetic first events, so the anchored operator itself continues them, and
adds the events they already counted. Only windows that can still reach an
event of the new batch (``anchor + W`` after its first arrival) are read.

An event that arrives in a later batch with an earlier time (source partitions
advance apart) belongs to the window that is open then, like any event before
the window's end: its time is raised to the window's anchor. Such windows are
looked up by key (`Carried.late`); there are none where batches follow each
other in time.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adsieve.functions import col_of, epoch_micros
from adsieve.operators.anchored import anchored_positions

DEDUPE = "dedupe"
SCHEMA = "key string, anchor_us long, n long"
LOOKUP_BYTES = 32 << 20  # of the late windows that are broadcast
_FIRST = -(1 << 62)  # before every event of the same time


@dataclass(frozen=True)
class Carried:
    """``windows (key, anchor_us, n)``, one row a key; ``late``: those that
    began after the batch's first arrival, None where there are none."""

    windows: DataFrame
    late: DataFrame | None = None


WindowHistory = Mapping[str, Carried]  # by the name of the window


def windows_of(routed: DataFrame, key: str, pos: str, anchor: str) -> DataFrame:
    """``(key, anchor_us, n)`` of the newest window of every key in ``routed``."""
    rows = routed.where(F.col(pos).isNotNull())
    newest = F.max(F.struct(epoch_micros(anchor).alias("anchor_us"), F.col(pos).alias("n"))).alias("w")
    return rows.groupBy(F.col(key).cast("string").alias("key")).agg(newest).select("key", "w.*")


def newest(windows: DataFrame) -> DataFrame:
    """One row a key: the newest of its windows, counted as far as any batch did."""
    return windows.groupBy("key").agg(F.max(F.struct("anchor_us", "n")).alias("w")).select("key", "w.*")


def live(windows: DataFrame, window_s: int, since: Column) -> DataFrame:
    """The newest window of each key, where it reaches past ``since``."""
    return newest(windows).where(F.col("anchor_us") + int(window_s) * 1_000_000 > epoch_micros(since))


def carried(windows: DataFrame, since: Column) -> Carried:
    """``windows`` (see `live`) with the late ones apart, after a look at their
    number: they are broadcast while that is small."""
    late = windows.where(F.col("anchor_us") > epoch_micros(since))
    size = late.agg(F.count(F.lit(1)), F.sum(F.octet_length("key"))).first()
    if not size[0]:
        return Carried(windows)
    return Carried(windows, F.broadcast(late) if size[0] * 32 + size[1] <= LOOKUP_BYTES else late)


def _at(anchor_us: str) -> Column:
    return F.timestamp_add("MICROSECOND", F.col(anchor_us), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def positions(df: DataFrame, history: Carried | None, key: str, window_s: int, counted: Column, pos_col: str,
              anchor_col: str, ts: str, **kw) -> DataFrame:
    """:func:`anchored_positions` that continues the windows of ``history``."""
    if history is None:
        return anchored_positions(df, key, window_s, ts=ts, counted=counted, pos_col=pos_col, anchor_col=anchor_col, **kw)
    own = col_of(key).cast("string")
    rows = df.withColumns({"aw_counted": counted, "aw_ts": F.col(ts).cast("timestamp_ntz")})
    if history.late is not None:
        late = history.late.select(F.col("key").alias("aw_key"), _at("anchor_us").alias("aw_at"))
        rows = rows.join(late, own == F.col("aw_key"), "left").withColumn("aw_ts", F.greatest("aw_ts", "aw_at")).drop("aw_key", "aw_at")
    seeds = history.windows.select(F.col("key").alias(key), _at("anchor_us").alias("aw_ts"), F.lit(_FIRST).alias("seq"), F.lit(True).alias("aw_seed"))
    both = rows.withColumn("aw_seed", F.lit(False)).unionByName(seeds, allowMissingColumns=True)
    takes_part = F.col("aw_seed") | F.coalesce("aw_counted", F.lit(False))
    placed = anchored_positions(both, key, window_s, ts="aw_ts", counted=takes_part, pos_col=pos_col, anchor_col=anchor_col, **kw) \
        .where(~F.col("aw_seed")).drop("aw_seed", "aw_counted", "aw_ts")
    before = history.windows.select(F.col("key").alias("aw_key"), _at("anchor_us").alias("aw_at"), F.col("n").alias("aw_n"))
    same = (own == F.col("aw_key")) & (F.col(anchor_col) == F.col("aw_at"))
    # the synthetic event took one position; the window had n
    total = F.col(pos_col) + F.coalesce(F.col("aw_n") - 1, F.lit(0))
    return placed.join(before, same, "left").withColumn(pos_col, total).drop("aw_key", "aw_at", "aw_n")
