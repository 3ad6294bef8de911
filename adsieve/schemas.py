"""StructType constants for every record shape of the pipeline."""

from __future__ import annotations

from pyspark.sql import types as T

# raw_events table as stored (event_date is the partition column).
RAW_EVENTS_TABLE = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("campaign_id", T.StringType()),
    T.StructField("geo_country", T.StringType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("ip_address", T.StringType()),
    T.StructField("risk_score", T.IntegerType()),
    T.StructField("meta_data", T.StringType()),
])

CAMPAIGN_STATS = T.StructType([
    T.StructField("campaign_id", T.StringType()),
    T.StructField("hour_bucket", T.TimestampNTZType()),
    T.StructField("total_impressions", T.LongType()),
    T.StructField("total_clicks", T.LongType()),
    T.StructField("total_conversions", T.LongType()),
])

STATS_COLUMNS = ["campaign_id", "total_impressions", "total_clicks", "total_conversions", "hour_bucket"]
