"""Status archive: records, partition columns, retention and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adsieve import config as C
from adsieve.functions import archive_time_parts, nz, rfc3339_nano


def archive_record(with_risk: bool = True, with_offset: bool = False) -> Column:
    """JSON text of one archived event.

    Empty ``event_id``/``ip_address``, a zero ``risk_score`` and an absent
    ``meta_data`` are left out, as an omit-empty encoder does.
    ``created_at`` is written in RFC 3339 form (fraction without trailing
    zeros, the event's own offset when ``created_offset`` is known).
    """
    fields = [
        F.nullif(nz("event_id"), F.lit("")).alias("event_id"),
        nz("event_type").alias("event_type"),
        nz("user_id").alias("user_id"),
        nz("campaign_id").alias("campaign_id"),
        nz("geo_country").alias("geo_country"),
        nz("device_type").alias("device_type"),
        rfc3339_nano("created_at", "created_offset" if with_offset else None).alias("created_at"),
        F.nullif(nz("ip_address"), F.lit("")).alias("ip_address"),
    ]
    if with_risk:
        fields.append(F.nullif(F.col("risk_score"), F.lit(0)).alias("risk_score"))
    fields.append(F.parse_json(F.col("meta_data")).alias("meta_data"))
    return F.to_json(F.struct(*fields))


def archive_rows(classified: DataFrame, upload_ts: Column | None = None,
                 keep: list[str] | None = None) -> DataFrame:
    """Two archive records per valid event: ``raw`` and its final status.

    ``raw`` is encoded before scoring, so it never carries ``risk_score``;
    duplicates have none either. Partition columns come from the UTC upload
    time (here the arrival time unless ``upload_ts`` is given).
    """
    up = upload_ts if upload_ts is not None else F.col("created_at")
    keep = keep or []
    off = "created_offset" in classified.columns
    base = classified.select("seq", *keep, "status", up.alias("_up"), archive_record(False, off).alias("_raw"),
                             archive_record(True, off).alias("_final"))
    both = base.select(
        "seq", *keep, "_up",
        F.explode(F.array(
            F.struct(F.lit("raw").alias("status"), F.col("_raw").alias("record")),
            F.struct(F.col("status").alias("status"), F.col("_final").alias("record")),
        )).alias("a"),
    )
    return both.select("seq", *keep, F.col("a.status").alias("status"), *archive_time_parts("_up"),
                       F.col("a.record").alias("record"))


def _records(archive: DataFrame) -> Column:
    """Rows are records, or folders of an archive index with their number."""
    return F.sum("n_records").cast("long") if "n_records" in archive.columns else F.count(F.lit(1))


def archive_counts(archive: DataFrame) -> DataFrame:
    """Records per status, of archive rows or of an archive index (which reads
    no archived object)."""
    return archive.groupBy("status").agg(_records(archive).alias("n_records"))


def archive_count_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """Growth per status between two archive snapshots (full outer join)."""
    b = archive_counts(before).withColumnRenamed("n_records", "n_before")
    a = archive_counts(after).withColumnRenamed("n_records", "n_after")
    j = b.join(a, "status", "full")
    return j.select("status", F.coalesce("n_before", F.lit(0)).alias("n_before"),
                    F.coalesce("n_after", F.lit(0)).alias("n_after"),
                    (F.coalesce("n_after", F.lit(0)) - F.coalesce("n_before", F.lit(0))).alias("n_growth"))


def archive_growth(archive: DataFrame, in_before: Column) -> DataFrame:
    """Same result as :func:`archive_count_delta` when the earlier snapshot
    is a subset of the later one (an append-only archive): one pass, one
    aggregation."""
    agg = archive.groupBy("status").agg(
        F.count_if(in_before).alias("n_before"), F.count(F.lit(1)).alias("n_after"))
    return agg.select("status", "n_before", "n_after", (F.col("n_after") - F.col("n_before")).alias("n_growth"))


def retention_policy(spark) -> DataFrame:
    """The 4-row expiry table (days per status prefix)."""
    rows = [(s, int(d)) for s, d in C.ARCHIVE_RETENTION_DAYS.items()]
    return spark.createDataFrame(rows, "status string, retention_days int")


def archive_expired(archive_parts: DataFrame, as_of: Column) -> DataFrame:
    """Archive partitions (status/year/month/day/hour) past their retention.

    ``archive_parts`` needs status, year, month, day, hour: archive rows, or
    the archive index, one row a folder. The policy table has one row per
    status, so it is broadcast (fixed size).
    """
    policy = F.broadcast(retention_policy(archive_parts.sparkSession))
    parts = archive_parts.groupBy("status", "year", "month", "day", "hour").agg(_records(archive_parts).alias("n_records"))
    ts = F.to_timestamp_ntz(F.concat_ws("-", "year", "month", "day"), F.lit("yyyy-MM-dd")) + F.make_interval(
        hours=F.col("hour").cast("int"))
    j = parts.join(policy, "status", "inner")
    expired = ts + F.make_interval(days=F.col("retention_days")) <= as_of.cast("timestamp_ntz")
    return j.where(expired).select("status", "year", "month", "day", "hour", "retention_days", "n_records")
