"""Every branch that a registered query claims to test has rows in the fixture."""

import pytest
from pyspark.sql import functions as F

from adsieve.config import FIXTURE_SCORING
from adsieve.operators.classify import classify
from adsieve.operators.decode import decode_messages, malformed_messages
from adsieve.operators.validate import storage_constraints
from adsieve.plans.catalog import REGISTRY
from adsieve.sources import fixtures as FX
from paths import SF01


@pytest.fixture(scope="module")
def routed(spark):
    return storage_constraints(classify(FX.ad_events(spark, SF01), FIXTURE_SCORING)).cache()


def test_statuses_and_violations(routed):
    counts = {r["status"]: r["count"] for r in routed.groupBy("status").count().collect()}
    assert set(counts) == {"accepted", "duplicate", "fraud"} and min(counts.values()) > 0
    broken = routed.where("status = 'accepted' and not persist_ok")
    assert broken.where("violation = 'user_id_too_long'").count() > 0
    assert routed.where("status = 'accepted' and meta_data is null").count() > 0


def test_requests_default_ids_and_times(spark):
    req = FX.collector_requests(spark, SF01)
    assert req.where("event_id = ''").count() > 0 and req.where("created_at is null").count() > 0
    assert FX.batch_requests(spark, SF01).select(F.explode("events").alias("e")).where("e.created_at is null").count() > 0


def test_odd_messages(spark):
    msgs = FX.kafka_messages(spark, SF01)
    bad = malformed_messages(msgs)
    for text in ("not json", '"user_id":123', "2024-02-30", "+24:00", "} x"):
        assert bad.where(F.contains("value", F.lit(text))).count() > 0, text
    assert bad.where(F.col("value").rlike(r"\d{4}-\d{2}-\d{2}t")).count() > 0
    good = decode_messages(msgs.withColumn("raw", F.col("value")))
    for text in ('"USER_ID":', "1234567Z", '{"x":1,"x":2}', "+05:30"):
        assert good.where(F.contains("raw", F.lit(text))).count() > 0, text
    assert good.where(F.contains("raw", F.lit('"USER_ID":')) & (F.col("user_id") != "")).count() > 0


def test_deltas_lookups_and_expiry(spark, routed):
    per_key = routed.where("status = 'accepted'").groupBy("campaign_id", F.date_trunc("hour", "created_at").alias("h")) \
        .agg(F.count_distinct(F.col("seq") % 5).alias("n"))
    assert per_key.where("n > 1").count() > 0
    statuses = {r["lookup_status"] for r in REGISTRY["campaign_lookup_status"].build(spark, SF01).collect()}
    assert statuses == {"found", "campaign not found", "campaign id is required"}
    assert {r["status"] for r in REGISTRY["archive_expired"].build(spark, SF01).collect()} == {"raw", "duplicate", "fraud", "accepted"}


def test_raw_events_scan_prunes_its_partitions(spark):
    df = REGISTRY["raw_events_scan"].build(spark, SF01).where(F.day("event_date") <= 15)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "day" in plan.split("PartitionFilters")[1]
    assert 0 < df.count()


def test_raw_events_are_scanned_whole(spark, routed):
    got = REGISTRY["raw_events_scan"].build(spark, SF01)
    assert got.count() == routed.where("status = 'accepted' and persist_ok").count()
    assert got.where("day(event_date) > 15").count() > 0
