"""Replay-safe writers.

Every output of a micro-batch is written under its ``batch_id`` partition
with dynamic partition overwrite, so replaying a batch replaces exactly its
own files (exactly-once results on top of at-least-once delivery). Segments of
folded batches (`segments`) are written by the same functions, under the name
of their range.
"""

from __future__ import annotations

import os
from functools import reduce
from urllib.parse import urlparse

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from adsieve.config import ArchiveConfig
from adsieve.operators.stats import merge_stats
from adsieve.schemas import CAMPAIGN_STATS, STATS_COLUMNS
from adsieve.sinks import segments

ARCHIVE_PARTS = ("status", "year", "month", "day", "hour")
ARCHIVE_SCHEMES = ("s3a", "s3", "gs", "abfs", "abfss", "hdfs", "file", "")


def check_archive_target(path: str) -> str:
    """Archive targets are object stores or file systems Hadoop can write."""
    scheme = urlparse(path).scheme
    if scheme not in ARCHIVE_SCHEMES:
        raise ValueError(f"unsupported archive target: {path}")
    return path


def _overwrite_partitions(df: DataFrame):
    df.sparkSession.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    return df.write.mode("overwrite")


def write_archive(archive_rows: DataFrame, path: str, batch_id: int | str, cfg: ArchiveConfig = ArchiveConfig()) -> None:
    """gzip NDJSON under status/year/month/day/hour (Hive form), one line per
    record, at most ``records_per_file`` records per object."""
    check_archive_target(path)
    out = archive_rows.select("record", *ARCHIVE_PARTS,
                              F.lit(str(batch_id)).alias("batch_id"))
    # rebalance, not repartition: one batch has one upload hour, so a plain
    # repartition by the path columns would send a whole status to one task;
    # AQE splits such partitions and merges small ones
    (
        _overwrite_partitions(out.hint("rebalance", "status", "year", "month", "day", "hour"))
        .partitionBy("status", "year", "month", "day", "hour", "batch_id")
        .option("compression", cfg.compression)
        .option("maxRecordsPerFile", cfg.records_per_file)
        .text(path)
    )


INDEX = "n_records long, status string, year string, month string, day string, hour string, batch_id string"


def write_archive_index(archive_rows: DataFrame, path: str, batch_id: int | str) -> None:
    """Records per archive folder, so that counting and expiry read no archive
    object. Aggregated before the shuffle: one row a folder."""
    out = archive_rows.groupBy(*ARCHIVE_PARTS).agg(F.count(F.lit(1)).alias("n_records")).withColumn("batch_id", F.lit(str(batch_id)))
    _overwrite_partitions(out.coalesce(1)).partitionBy("batch_id").parquet(path)


def read_archive_index(spark: SparkSession, path: str) -> DataFrame:
    """``status, year, month, day, hour, n_records`` of the live folders."""
    return segments.load(spark, os.path.dirname(path)).only(spark.read.schema(INDEX).parquet(path)).drop("batch_id")


def write_raw_events(rows: DataFrame, path: str, batch_id: int | str) -> None:
    """Append accepted events to raw_events (partitioned by event_date);
    files are clustered by campaign_id so lookups prune row groups."""
    out = rows.withColumn("batch_id", F.lit(str(batch_id)))
    (
        # the partition columns lead the sort, so the write keeps it (campaign
        # clustering gives row-group pruning on campaign lookups)
        _overwrite_partitions(out.hint("rebalance", "event_date")
                              .sortWithinPartitions("event_date", "batch_id", "campaign_id", "created_at"))
        .partitionBy("event_date", "batch_id")
        .parquet(path)
    )


def write_stats_delta(deltas: DataFrame, path: str, batch_id: int | str) -> None:
    """One delta file set per batch id; campaign_stats = sum over deltas."""
    out = deltas.select(*STATS_COLUMNS).withColumn("batch_id", F.lit(str(batch_id)))
    _overwrite_partitions(out).partitionBy("batch_id").parquet(path)


def read_deltas(spark: SparkSession, path: str) -> DataFrame:
    """Every stored stats row with its ``batch_id``."""
    return spark.read.schema(StructType([*CAMPAIGN_STATS.fields, StructField("batch_id", StringType())])).parquet(path)


def read_stats(spark: SparkSession, path: str) -> DataFrame:
    """campaign_stats as the additive merge of the live segments and every
    batch delta after them."""
    return merge_stats(segments.load(spark, os.path.dirname(path)).only(read_deltas(spark, path)))


def compact_stats(spark: SparkSession, delta_path: str, base_out: str, upto_batch: int,
                  prev_base: str | None = None) -> None:
    """Fold closed batch ids (``<= upto_batch``) and an optional previous
    base into a new base version at ``base_out`` (never written in place)."""
    parts = [read_deltas(spark, delta_path).where(F.col("batch_id").try_cast("long") <= upto_batch)]
    if prev_base:
        parts.append(spark.read.parquet(prev_base))
    merge_stats(*parts).write.mode("overwrite").parquet(base_out)


def read_stats_compacted(spark: SparkSession, base: str, delta_path: str, after_batch: int) -> DataFrame:
    """campaign_stats = compacted base + the deltas of later batches."""
    return merge_stats(spark.read.parquet(base),
                       read_deltas(spark, delta_path).where(F.col("batch_id").try_cast("long") > after_batch))


def write_partition(rows: DataFrame, path: str, batch_id: int | str) -> None:
    """Rows of one batch or segment, as they are."""
    _overwrite_partitions(rows.withColumn("batch_id", F.lit(str(batch_id))).coalesce(1)).partitionBy("batch_id").parquet(path)


def write_rows(rows: DataFrame, path: str, batch_id: int | str) -> None:
    """Many rows of one batch, rebalanced by size."""
    _overwrite_partitions(rows.withColumn("batch_id", F.lit(str(batch_id))).hint("rebalance")).partitionBy("batch_id").parquet(path)


def write_metrics(metrics: DataFrame, path: str, batch_id: int | str) -> None:
    out = metrics.withColumn("batch_id", F.lit(str(batch_id)))
    _overwrite_partitions(out.coalesce(1)).partitionBy("batch_id").parquet(path)


def write_windows(windows: dict[str, DataFrame], path: str, batch_id: int | str) -> None:
    """Window state that a batch leaves, ordered by anchor so that a later
    batch reads only the files whose windows can still matter."""
    write_window_rows(reduce(DataFrame.unionByName, [w.withColumn("kind", F.lit(name)) for name, w in windows.items()]), path, batch_id)


def write_window_rows(rows: DataFrame, path: str, batch_id: int | str) -> None:
    out = rows.withColumn("batch_id", F.lit(str(batch_id))).hint("rebalance", "kind")
    _overwrite_partitions(out.sortWithinPartitions("kind", "batch_id", "anchor_us")).partitionBy("kind", "batch_id").parquet(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Metrics rows of every batch (``n_events, started_at, finished_at``, ...)."""
    return segments.load(spark, os.path.dirname(path)).only(spark.read.parquet(path))


WINDOWS = "key string, anchor_us long, n long, kind string, batch_id string"


def read_windows(spark: SparkSession, path: str) -> DataFrame | None:
    """Live window state, or None before the first batch."""
    try:
        return segments.load(spark, os.path.dirname(path)).only(spark.read.schema(WINDOWS).parquet(path))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


PROGRESS = "source long, arrival timestamp_ntz, batch_id string"


def write_progress(progress: DataFrame, path: str, batch_id: int | str) -> None:
    """How far each source partition has come (``source, arrival``)."""
    out = progress.select("source", "arrival", F.lit(str(batch_id)).alias("batch_id"))
    _overwrite_partitions(out.coalesce(1)).partitionBy("batch_id").parquet(path)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    return segments.load(spark, os.path.dirname(path)).only(spark.read.schema(PROGRESS).parquet(path))


def write_quarantine(rows: DataFrame, path: str, batch_id: int | str) -> None:
    out = rows.withColumn("batch_id", F.lit(str(batch_id)))
    _overwrite_partitions(out).partitionBy("batch_id").parquet(path)


def kafka_options(brokers: str, topic: str) -> dict[str, str]:
    """Producer settings: all acks, retries, snappy, key-hash partitioning
    (Kafka's default partitioner hashes the key)."""
    return {
        "kafka.bootstrap.servers": brokers,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.retries": "5",
        "kafka.compression.type": "snappy",
        "kafka.enable.idempotence": "true",
    }


def write_kafka(rows: DataFrame, brokers: str, topic: str) -> None:
    """Publish (key, value) rows (needs the spark-sql-kafka package)."""
    rows.select("key", "value").write.format("kafka").options(**kafka_options(brokers, topic)).save()
