"""Pipeline invariants on the derived fixture (sf0.01)."""

from pyspark.sql import functions as F

from adsieve.config import FIXTURE_SCORING
from adsieve.operators import archive as A
from adsieve.operators import classify as K
from adsieve.operators import stats as S
from adsieve.sources import fixtures as FX
from paths import SF01


def test_invariants(spark):
    routed = K.classify(FX.ad_events(spark, SF01), FIXTURE_SCORING, keep_rejected=True).cache()
    by = {r["status"]: r["count"] for r in routed.groupBy("status").count().collect()}
    # FIXTURES.md counts at sf0.01
    assert by == {"rejected": 2492, "duplicate": 1110, "fraud": 2242, "accepted": 4156}
    valid = routed.where("status <> 'rejected'")
    arch = {r["status"]: r["n_records"] for r in A.archive_counts(A.archive_rows(valid)).collect()}
    assert arch["raw"] == arch["duplicate"] + arch["fraud"] + arch["accepted"] == 7508
    acc = routed.where("status = 'accepted'")
    st = S.campaign_hour_stats(acc).agg(
        F.sum(F.col("total_impressions") + F.col("total_clicks") + F.col("total_conversions"))).first()[0]
    assert st == by["accepted"]
    # duplicates never touch the IP counter; fraud rows do
    assert routed.where("status = 'duplicate' AND ip_pos IS NOT NULL").count() == 0
    assert routed.where("status = 'fraud' AND ip_pos IS NULL").count() == 0
    # blank IPs score 0 and are never counted
    assert routed.where("trim(ip_address) = '' AND status <> 'rejected' AND (risk_score <> 0 OR ip_pos IS NOT NULL)").count() == 0
    routed.unpersist()
