"""The newest row per campaign, kept up to date from stats deltas.

A lookup reads one bucket of a table instead of all hours of all campaigns.
Hour sums need every delta of that hour, so the table keeps, per campaign, the
newest hour with its running sums, and a delta merges in one step: a newer hour
replaces the row, the same hour adds to it, an older hour changes nothing. The
merge is associative and commutative, so batches may arrive in any order.

The table is versioned like a manifest: each version is a folder of its own,
committed by its ``_BATCHES`` file, which names the batches it holds; readers
take the newest complete version, and a batch that a version holds is not added
again. Buckets are a partition column, so a lookup lists and reads one.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adsieve.sinks import segments

BUCKETS = 64
COUNTS = ["total_impressions", "total_clicks", "total_conversions"]
SCHEMA = "campaign_id string, hour_bucket timestamp_ntz, total_impressions long, total_clicks long, total_conversions long, bucket int"
KEPT = 3  # versions


def bucket_of(campaign_id: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(campaign_id), F.lit(buckets)).cast("int")


def newest_hours(*parts: DataFrame) -> DataFrame:
    """Per campaign, its newest hour with the sums of all rows of that hour.
    Two aggregations that both combine before the shuffle."""
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    hours = rows.groupBy("campaign_id", "hour_bucket").agg(*(F.sum(c).cast("long").alias(c) for c in COUNTS))
    newest = F.max(F.struct("hour_bucket", *COUNTS)).alias("row")
    return hours.groupBy("campaign_id").agg(newest).select("campaign_id", "row.*")


def _versions(spark: SparkSession, root: str) -> list[int]:
    names = [n.removeprefix("version=") for n in segments.names(spark, root) if n.startswith("version=")]
    return sorted(int(n) for n in names if n.isdigit() and segments.exists(spark, f"{root}/version={n}/_BATCHES"))


def held(spark: SparkSession, root: str) -> tuple[int, list[list[int]]]:
    """(newest version, ranges of the batches in it)."""
    found = _versions(spark, root)
    if not found:
        return 0, []
    return found[-1], json.loads(segments.read_text(spark, f"{root}/version={found[-1]}/_BATCHES"))


def with_batch(ranges: list[list[int]], batch_id: int) -> list[list[int]]:
    """Ranges that hold ``batch_id`` as well; neighbours become one."""
    out: list[list[int]] = []
    for lo, hi in sorted([*ranges, [batch_id, batch_id]]):
        if out and lo <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return out


def add(spark: SparkSession, root: str, deltas: DataFrame, batch_id: int, buckets: int = BUCKETS) -> bool:
    """Merge one batch's deltas into a new version; False if it is held already."""
    version, batches = held(spark, root)
    if any(lo <= batch_id <= hi for lo, hi in batches):
        return False
    columns = ["campaign_id", "hour_bucket", *COUNTS]
    parts = [deltas.select(*columns)]
    if version:
        parts.append(read(spark, root).select(*columns))
    rows = newest_hours(*parts).withColumn("bucket", bucket_of(F.col("campaign_id"), buckets))
    path = f"{root}/version={version + 1}"
    rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", "campaign_id").write.mode("overwrite").partitionBy("bucket").parquet(path)
    segments.write_text(spark, f"{path}/_BATCHES", json.dumps(with_batch(batches, batch_id)))
    for old in _versions(spark, root)[:-KEPT]:
        segments.remove(spark, f"{root}/version={old}")
    return True


def read(spark: SparkSession, root: str) -> DataFrame:
    """Newest row of every campaign."""
    version, _ = held(spark, root)
    if not version:
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(f"{root}/version={version}")


def lookup(spark: SparkSession, root: str, campaign_id: str, buckets: int = BUCKETS) -> DataFrame:
    """The newest row of one campaign (none or one row), from one bucket."""
    if not campaign_id:
        raise ValueError("campaign id is required")
    # folded to a literal, so the partition filter needs no scan
    bucket = spark.range(1).select(bucket_of(F.lit(campaign_id), buckets)).first()[0]
    return read(spark, root).where((F.col("bucket") == bucket) & (F.col("campaign_id") == campaign_id)).drop("bucket")
