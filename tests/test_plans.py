"""Plan checks: filters and column pruning reach the parquet scan, the
anchored operator shares its shuffle, and no stray cross joins appear."""

import os
import tempfile

from adsieve.config import FIXTURE_SCORING
from adsieve.operators import classify as K
from adsieve.operators import stats as S
from adsieve.sources import fixtures as FX
from adsieve.sources.tables import read_campaign_stats, read_raw_events
from paths import SF001


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _stored(spark):
    root = tempfile.mkdtemp(prefix="adsieve-plan-", dir="/tmp")
    acc = K.classify(FX.ad_events(spark, SF001), FIXTURE_SCORING).where("status = 'accepted'")
    S.campaign_hour_stats(acc).write.parquet(os.path.join(root, "stats"))
    acc.selectExpr("event_id", "event_type", "user_id", "campaign_id", "geo_country", "device_type",
                   "created_at", "ip_address", "risk_score", "meta_data",
                   "to_date(created_at) AS event_date").write.partitionBy("event_date").parquet(
        os.path.join(root, "raw"))
    return root


def test_lookup_pushes_filter_and_prunes(spark):
    root = _stored(spark)
    stats = read_campaign_stats(spark, os.path.join(root, "stats"))
    plan = _plan(S.campaign_by_id(stats, "cmp-3"))
    assert "PushedFilters: [IsNotNull(campaign_id), EqualTo(campaign_id,cmp-3)]" in plan
    raw = read_raw_events(spark, os.path.join(root, "raw"))
    q = raw.where("event_date = DATE'2024-01-02'").groupBy("campaign_id").count()
    plan = _plan(q)
    assert "ReadSchema: struct<campaign_id:string>" in plan
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_anchored_shares_its_shuffle(spark):
    df = K.mark_duplicates(FX.ad_events(spark, SF001), FIXTURE_SCORING)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in final
    assert "ReusedExchange" in final  # phases 1 and 3 read one (key, chunk) shuffle
    assert "CartesianProduct" not in final and "BroadcastNestedLoopJoin" not in final


def test_decode_steps_are_not_repeated_by_a_filter(spark):
    # a keep/drop filter below the decode projection parses a message once for each use of a parsed column
    from adsieve.plans.catalog import REGISTRY
    for name in ("decode_messages", "malformed_messages", "request_bodies"):
        plan = REGISTRY[name].build(spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
        assert "Filter" not in plan and "Generate inline" in plan, name


def test_hourly_stats_aggregate_map_side(spark):
    acc = FX.ad_events(spark, SF001)
    plan = _plan(S.campaign_hour_stats(acc))
    assert plan.count("HashAggregate") >= 2  # partial + final


def test_archive_write_rebalances(spark):
    from pyspark.sql import functions as F

    from adsieve.operators import archive as A
    arch = A.archive_rows(K.classify(FX.ad_events(spark, SF001), FIXTURE_SCORING),
                          F.lit("2024-02-01 10:00:00").cast("timestamp_ntz"))
    out = arch.select("record", "status", "year", "month", "day", "hour").hint(
        "rebalance", "status", "year", "month", "day", "hour")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan  # AQE may split a hot status-hour
