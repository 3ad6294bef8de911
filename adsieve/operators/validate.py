"""Event validation (first failing field wins) and storage constraints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adsieve import config as C
from adsieve.functions import nz


def reject_field() -> Column:
    """Name of the first failing field, null when the event is valid."""
    et, geo = nz("event_type"), nz("geo_country")
    return (
        F.when(~et.isin(*C.EVENT_TYPES), "event_type")
        .when(nz("user_id") == "", "user_id")
        .when(nz("campaign_id") == "", "campaign_id")
        .when(geo == "", "geo_country")
        .when(F.octet_length(geo) != 2, "geo_country")
        .when(nz("device_type") == "", "device_type")
    )


def reject_message() -> Column:
    et, geo = nz("event_type"), nz("geo_country")
    return (
        F.when(~et.isin(*C.EVENT_TYPES), F.concat(F.lit(C.MSG_EVENT_TYPE), et))
        .when(nz("user_id") == "", C.MSG_USER_ID)
        .when(nz("campaign_id") == "", C.MSG_CAMPAIGN_ID)
        .when(geo == "", C.MSG_GEO_REQUIRED)
        .when(F.octet_length(geo) != 2, C.MSG_GEO_LENGTH)
        .when(nz("device_type") == "", C.MSG_DEVICE_TYPE)
    )


def validate_events(df: DataFrame) -> DataFrame:
    """Add ``reject_field`` / ``reject_message`` (null on valid rows)."""
    return df.withColumn("reject_field", reject_field()).withColumn("reject_message", reject_message())


def valid_events(df: DataFrame) -> DataFrame:
    return df.where(reject_field().isNull())


def reject_counts(df: DataFrame) -> DataFrame:
    """Rejected events per failing field."""
    return (
        validate_events(df).where(F.col("reject_field").isNotNull())
        .groupBy("reject_field").agg(F.count(F.lit(1)).alias("n_rejected"))
    )


def storage_violation() -> Column:
    """First storage constraint an accepted event would break on insert.

    The table checks NOT NULL, the event_type CHECK and VARCHAR limits in
    characters. Null when the row can be stored.
    """
    cond = F.when(~nz("event_type").isin(*C.EVENT_TYPES), F.lit("event_type_check"))
    for colname, limit in C.RAW_EVENTS_VARCHAR.items():
        cond = cond.when(F.char_length(nz(colname)) > limit, F.lit(f"{colname}_too_long"))
    return cond.when(F.col("created_at").isNull(), F.lit("created_at_null"))


def storage_constraints(df: DataFrame) -> DataFrame:
    """Add ``persist_ok`` and ``violation``; rows are kept either way."""
    v = storage_violation()
    return df.withColumn("violation", v).withColumn("persist_ok", v.isNull())
