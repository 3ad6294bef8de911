"""Hourly campaign statistics and the query side over them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adsieve import config as C
from adsieve.functions import hour_bucket, onehot, rfc3339_nano
from adsieve.schemas import STATS_COLUMNS


def event_onehot(df: DataFrame) -> DataFrame:
    """Add impressions / clicks / conversions indicator columns (0/1)."""
    return df.select("*", *onehot("event_type"))


def campaign_hour_stats(accepted: DataFrame) -> DataFrame:
    """Counts per (campaign_id, hour_bucket) of accepted events.

    Plain groupBy: Spark pre-aggregates map-side, so only one row per
    (partition, campaign, hour) crosses the shuffle even for a hot campaign.
    """
    return (
        accepted.select("campaign_id", hour_bucket("created_at").alias("hour_bucket"), *onehot("event_type"))
        .groupBy("campaign_id", "hour_bucket")
        .agg(
            F.sum("impressions").alias("total_impressions"),
            F.sum("clicks").alias("total_clicks"),
            F.sum("conversions").alias("total_conversions"),
        )
    )


def merge_stats(*deltas: DataFrame) -> DataFrame:
    """Additive upsert: old + new counts per key; absent keys are inserted."""
    frames: Iterable[DataFrame] = iter(deltas)
    acc = next(frames).select(*STATS_COLUMNS)
    for d in frames:
        acc = acc.unionByName(d.select(*STATS_COLUMNS))
    return acc.groupBy("campaign_id", "hour_bucket").agg(
        F.sum("total_impressions").cast("long").alias("total_impressions"),
        F.sum("total_clicks").cast("long").alias("total_clicks"),
        F.sum("total_conversions").cast("long").alias("total_conversions"),
    )


def stats_by_batch(accepted: DataFrame, batch_col: str = "batch_id") -> DataFrame:
    """Per-batch deltas (the rows a micro-batch adds), keyed by batch id."""
    return (
        accepted.select(batch_col, "campaign_id", hour_bucket("created_at").alias("hour_bucket"), *onehot("event_type"))
        .groupBy(batch_col, "campaign_id", "hour_bucket")
        .agg(
            F.sum("impressions").alias("total_impressions"),
            F.sum("clicks").alias("total_clicks"),
            F.sum("conversions").alias("total_conversions"),
        )
    )


def stats_view(deltas: DataFrame) -> DataFrame:
    """campaign_stats = sum over all batch deltas (replayed batches overwrite
    their own delta, so the sum is exactly-once)."""
    return merge_stats(deltas)


def all_campaigns(stats: DataFrame) -> DataFrame:
    """Every (campaign, hour) row, newest hour first (campaign as tie-break)."""
    return stats.select(*STATS_COLUMNS).orderBy(F.col("hour_bucket").desc(), F.col("campaign_id"))


def campaign_by_id(stats: DataFrame, campaign_id: str) -> DataFrame:
    """One row for the campaign: its latest hour. Empty when unknown."""
    if not campaign_id:
        raise ValueError(C.LOOKUP_BAD_REQUEST)
    return (
        stats.where(F.col("campaign_id") == F.lit(campaign_id))
        .select(*STATS_COLUMNS)
        .orderBy(F.col("hour_bucket").desc())
        .limit(1)
    )


def latest_by_campaign(stats: DataFrame) -> DataFrame:
    """Latest hour row of every campaign (the many-ids form of the lookup).

    An aggregation (``max_by``) rather than a window: it pre-aggregates
    map-side, so a campaign with very many hours never lands whole in one
    task.
    """
    row = F.struct(*[c for c in STATS_COLUMNS if c != "campaign_id"])
    latest = stats.groupBy("campaign_id").agg(F.max_by(row, F.col("hour_bucket")).alias("_r"))
    return latest.select("campaign_id", *[F.col(f"_r.{c}").alias(c) for c in STATS_COLUMNS if c != "campaign_id"])


def campaign_lookup_status(stats: DataFrame, requested: DataFrame) -> DataFrame:
    """Outcome per requested id: bad request (empty), not found, or found with
    the latest-hour row. ``requested`` has a ``campaign_id`` column."""
    latest = latest_by_campaign(stats)
    req = requested.select(F.coalesce(F.col("campaign_id"), F.lit("")).alias("campaign_id")).distinct()
    j = req.join(latest, "campaign_id", "left")
    status = (
        F.when(F.col("campaign_id") == "", C.LOOKUP_BAD_REQUEST)
        .when(F.col("hour_bucket").isNull(), C.LOOKUP_NOT_FOUND)
        .otherwise(C.LOOKUP_FOUND)
    )
    return j.select("campaign_id", status.alias("lookup_status"), "total_impressions", "total_clicks",
                    "total_conversions", "hour_bucket")


def campaign_json_rows(stats: DataFrame) -> DataFrame:
    """One ``{"data": {...}}`` response body per stats row (the lookup
    response); times in RFC 3339 (UTC, ``Z``)."""
    fields = [F.col(c) for c in STATS_COLUMNS if c != "hour_bucket"]
    body = F.struct(F.struct(*fields, rfc3339_nano("hour_bucket").alias("hour_bucket")).alias("data"))
    return stats.select("campaign_id", F.to_json(body).alias("body"))
