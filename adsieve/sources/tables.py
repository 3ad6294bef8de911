"""Readers for the base parquet tables and the pipeline's own tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DateType, StructField, StructType

from adsieve import schemas
from adsieve.sinks import segments


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_events_schema() -> StructType:
    return StructType([*schemas.RAW_EVENTS_TABLE.fields, StructField("event_date", DateType())])


def read_raw_events(spark: SparkSession, path: str) -> DataFrame:
    """Scan the stored raw_events table (partitioned by event_date)."""
    return segments.load(spark, os.path.dirname(path)).only(spark.read.schema(raw_events_schema()).parquet(path))


def read_campaign_stats(spark: SparkSession, path: str) -> DataFrame:
    """Scan a materialised campaign_stats table."""
    return spark.read.schema(schemas.CAMPAIGN_STATS).parquet(path)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Read the status archive back: each record as its JSON text, with the
    partition values as strings. The schema is given, so nothing is read to
    infer it."""
    schema = "record string, status string, year string, month string, day string, hour string"
    return segments.load(spark, os.path.dirname(path)).only(spark.read.schema(schema).text(path))
