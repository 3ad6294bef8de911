"""Rules of single operators and the end-to-end scenario, on small tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from adsieve.config import ScoringConfig
from adsieve.functions import client_ip, hour_bucket, wall_clock
from adsieve.operators import classify as K
from adsieve.operators import decode as D
from adsieve.operators import stats as S
from adsieve.operators import validate as V

# a sound event, and per checked field the values that must fail it
SOUND = {"event_type": "conversion", "user_id": "u-77", "campaign_id": "spring", "geo_country": "FR", "device_type": "tv"}
BROKEN = {"event_type": ["", "Click", "view "], "user_id": [""], "campaign_id": [""], "geo_country": ["", "F", "FRA"], "device_type": [""]}


def test_validation_reports_the_first_failing_field(spark):
    rows, want = [], {}

    def add(**changes):
        event = SOUND | changes
        rows.append((len(rows), *event.values()))
        want[len(rows) - 1] = next((f for f in SOUND if event[f] in BROKEN[f]), None)

    add()
    for first, values in BROKEN.items():
        for value in values:
            add(**{first: value})
            for second, others in BROKEN.items():  # two failing fields at once: the order decides
                add(**{first: value, second: others[-1]})
    for field in ("user_id", "campaign_id", "device_type"):
        add(**{field: "  "})  # blank is not missing
    add(geo_country="  ")
    schema = "n long, " + ", ".join(f"{f} string" for f in SOUND)
    got = {r["n"]: r["reject_field"] for r in V.validate_events(spark.createDataFrame(rows, schema)).collect()}
    assert got == want


def test_geo_length_counts_bytes(spark):
    df = spark.createDataFrame([("click", "u", "c", "é", "m")],
                               "event_type string, user_id string, campaign_id string, geo_country string, device_type string")
    assert V.validate_events(df).first()["reject_field"] is None  # 'é' is two bytes


def test_blank_counts_unicode_white_space(spark):
    from adsieve.functions import blank
    df = spark.createDataFrame([("\u00a0",), ("\u3000 ",), ("\u2028\t",), ("\u200b",), ("1.2.3.4\u00a0",)], "ip string")
    assert [r[0] for r in df.select(blank("ip")).collect()] == [True, True, True, False, False]


def test_client_ip(spark):
    peer = "172.20.9.3"
    forwarded = {"100.64.3.8,192.0.2.77": "100.64.3.8", " 2001:db8::17 , 192.0.2.1, 192.0.2.2": "2001:db8::17", "\n192.0.2.66\t": "192.0.2.66"}
    rows = [(chain, real, peer, first) for chain, first in forwarded.items() for real in ("", "192.0.2.250")]
    rows += [("", "192.0.2.250", peer, "192.0.2.250"), ("", "", peer, peer), (",192.0.2.9", "192.0.2.250", peer, "")]
    df = spark.createDataFrame(rows, "xff string, xri string, remote string, want string")
    assert [r for r in df.select("want", client_ip("xff", "xri", "remote").alias("got")).collect() if r.want != r.got] == []


@pytest.mark.parametrize("offset", ["Z", "-03:30", "+12:45"])
def test_hour_bucket_keeps_wall_clock(spark, offset):
    rows = [(f"2025-07-{d:02d}T{h:02d}:{m:02d}:59.{f}{offset}", dt.datetime(2025, 7, d, h), dt.datetime(2025, 7, d, h, m, 59, us))
            for d, h, m, f, us in [(1, 0, 0, "000001", 1), (9, 23, 59, "9", 900_000), (30, 6, 31, "7654321987", 765_432)]]
    df = spark.createDataFrame(rows, "ts string, hour timestamp_ntz, wall timestamp_ntz").select("*", wall_clock("ts").alias("w"))
    assert df.where((F.col("w") != F.col("wall")) | (hour_bucket("w") != F.col("hour"))).count() == 0


def test_decode_rules(spark):
    msgs = [
        (1, '{"event_id":"e1","event_type":"click","user_id":"u","campaign_id":"c","geo_country":"IN",'
            '"device_type":"m","timestamp":"2024-01-01T10:00:00Z","meta_data":{"b":1,"a":2}}'),
        (2, '{"user_id":123}'),               # number in a string field
        (3, 'not json'),
        (4, 'null'),                          # decodes to an empty event
        (5, '{"timestamp":"yesterday"}'),     # not RFC 3339
        (6, '{"meta_data":[1]}'),             # not an object
        (7, '{"user_id":null,"user_id":"x"}'),  # last key wins
        (8, '[1,2]'),
        (9, '{"user_id":"a"} x'),            # trailing text
        (10, '{"user_id":"a"}{"user_id":"b"}'),  # two values
        (11, ''),                            # empty body
        (12, '  {"user_id":"a"}  '),         # surrounding blanks are fine
        (13, '{"USER_ID":"A","meta_data":{"x":{"y":1,"y":2}}}'),  # any case; nested keys repeat
        (14, '{"user_id":"a","User_Id":null}'),  # null leaves what stands
        (15, '{"user_id":"a","USER_ID":1}'),  # every spelling must have the type
        (16, '{"timestamp":"2024-02-30T10:00:00Z"}'),
        (17, '{"timestamp":"2024-13-01T10:00:00Z"}'),
        (18, '{"timestamp":"2024-01-01T25:00:00Z"}'),
        (19, '{"timestamp":"2024-01-01t10:00:00Z"}'),
        (20, '{"timestamp":"2024-01-01T10:00:00z"}'),
        (21, '{"timestamp":"2024-01-01T10:00:00+24:00"}'),
        (22, '{"timestamp":"2024-01-01T10:00:00.123456789012+23:59"}'),
        (23, "{'user_id':'a'}"),
        (24, None),
    ]
    df = spark.createDataFrame(msgs, "seq long, value string")
    good = {r["seq"]: r for r in D.decode_messages(df).collect()}
    assert sorted(good) == [1, 4, 7, 12, 13, 14, 22]
    assert good[13]["user_id"] == "A" and good[13]["meta_data"] == '{"x":{"y":2}}' and good[14]["user_id"] == "a"
    raw = {r["seq"]: r["created_at"] for r in D.to_raw_event(D.decode_messages(df.withColumn("arrival", F.lit(None).cast("timestamp_ntz")))).collect()}
    assert raw[22] == dt.datetime(2024, 1, 1, 10, 0, 0, 123456)
    assert good[1]["meta_data"] == '{"a":2,"b":1}'
    assert good[4]["event_type"] == "" and good[4]["timestamp"] is None
    assert good[7]["user_id"] == "x"
    bad = sorted(r["seq"] for r in D.malformed_messages(df).collect())
    assert bad == [2, 3, 5, 6, 8, 9, 10, 11, 15, 16, 17, 18, 19, 20, 21, 23, 24]


def _golden(spark, threshold=100):
    t0 = dt.datetime(2026, 1, 1, 12, 0, 0)
    rows, seq = [], 0

    def add(eid, et, camp, ip):
        nonlocal seq
        rows.append((seq, eid, et, "user-1", camp, "US", "mobile", t0 + dt.timedelta(milliseconds=seq * 50), ip, None))
        seq += 1

    add("probe-1", "impression", "camp-probe", "203.0.113.10")
    add("acc-1", "impression", "camp-test", "203.0.113.10")
    add("dup-1", "click", "camp-test", "203.0.113.10")
    add("dup-1", "click", "camp-test", "203.0.113.10")
    for i in range(threshold + 1):
        add(f"hot-{i}", "impression", "camp-test", "198.51.7.9")
    schema = ("seq long, event_id string, event_type string, user_id string, campaign_id string, geo_country string, "
              "device_type string, created_at timestamp_ntz, ip_address string, meta_data string")
    return spark.createDataFrame(rows, schema)


def test_golden_scenario(spark):
    cfg = ScoringConfig()  # production settings: 300 s window, threshold 100
    cls = K.classify(_golden(spark), cfg).cache()
    test = cls.where(F.col("campaign_id") == "camp-test")
    counts = {r["status"]: r["count"] for r in test.groupBy("status").count().collect()}
    assert test.count() == 104  # raw archive records for the campaign
    assert counts == {"accepted": 102, "duplicate": 1, "fraud": 1}
    acc = test.where("status = 'accepted'")
    assert acc.where("ip_address = '198.51.7.9'").count() == 100
    assert acc.where("risk_score > 80").count() == 0
    assert cls.agg(F.max("ip_pos")).first()[0] == 101  # hot counter
    st = S.campaign_hour_stats(cls.where("status = 'accepted'")).where("campaign_id = 'camp-test'")
    tot = st.agg(F.sum("total_impressions"), F.sum("total_clicks"), F.sum("total_conversions")).first()
    assert tuple(tot) == (101, 1, 0)
    assert cls.where("event_id = 'hot-100'").first()["risk_score"] == 90


def test_lookup_service(spark):
    stats = S.campaign_hour_stats(K.classify(_golden(spark), ScoringConfig()).where("status = 'accepted'"))
    assert S.all_campaigns(stats).count() == 2
    assert S.campaign_by_id(stats, "camp-test").first()["total_impressions"] == 101
    assert S.campaign_by_id(stats, "nope").count() == 0
    with pytest.raises(ValueError):
        S.campaign_by_id(stats, "")
    req = spark.createDataFrame([("camp-test",), ("nope",), ("",)], "campaign_id string")
    got = {r["campaign_id"]: r["lookup_status"] for r in S.campaign_lookup_status(stats, req).collect()}
    assert got == {"camp-test": "found", "nope": "campaign not found", "": "campaign id is required"}


def test_archive_keeps_event_offset_and_trims_fraction(spark):
    import json
    from adsieve.operators.archive import archive_record
    msgs = spark.createDataFrame([
        (1, '{"event_id":"e1","event_type":"click","user_id":"u","campaign_id":"c","geo_country":"IN",'
            '"device_type":"m","timestamp":"2026-02-28T19:47:33.120000+05:30"}'),
        (2, '{"event_id":"e2","event_type":"click","user_id":"u","campaign_id":"c","geo_country":"IN",'
            '"device_type":"m","timestamp":"2026-02-28T19:00:00Z","ip_address":"1.2.3.4"}'),
    ], "seq long, value string").withColumn("arrival", F.lit(dt.datetime(2026, 3, 1)).cast("timestamp_ntz"))
    ev = D.to_raw_event(D.decode_messages(msgs)).withColumn("risk_score", F.lit(10))
    rec = {r["seq"]: json.loads(r["j"]) for r in ev.select("seq", archive_record(True, True).alias("j")).collect()}
    assert rec[1]["created_at"] == "2026-02-28T19:47:33.12+05:30"
    assert rec[2]["created_at"] == "2026-02-28T19:00:00Z"
    assert "ip_address" not in rec[1] and rec[2]["ip_address"] == "1.2.3.4"
    assert rec[1]["risk_score"] == 10 and "meta_data" not in rec[1]


def test_default_ids_are_retry_stable(spark):
    from adsieve.operators import ingest as I
    df = spark.createDataFrame([(1, "", "click", "u", "c", None), (2, "given", "click", "u", "c", None)],
                               "seq long, event_id string, event_type string, user_id string, campaign_id string, "
                               "created_at timestamp_ntz")
    df = df.selectExpr("*", "'' AS xff", "'' AS x_real_ip", "'10.0.0.1' AS remote_ip",
                       "timestamp_ntz'2026-01-01 00:00:05' AS received_at")
    a = {r["seq"]: r["event_id"] for r in I.normalize_requests(df).collect()}
    b = {r["seq"]: r["event_id"] for r in I.normalize_requests(df).collect()}
    assert a == b and a[2] == "given" and len(a[1]) == 36
    # a missing time is the request's
    assert {r["created_at"] for r in I.normalize_requests(df).collect()} == {dt.datetime(2026, 1, 1, 0, 0, 5)}


def test_archive_expiry_per_status(spark):
    from adsieve.operators.archive import archive_expired
    parts = spark.createDataFrame([
        ("duplicate", "2026", "03", "01", "10"),   # 1 day: expired at 03-02 10:00
        ("duplicate", "2026", "03", "01", "11"),   # not yet
        ("raw", "2026", "02", "16", "10"),         # 14 days: expired
        ("fraud", "2026", "02", "01", "10"),       # 30 days: not yet (03-03)
        ("accepted", "2025", "12", "02", "10"),    # 90 days: expired (03-02)
        ("accepted", "2025", "12", "03", "10"),    # not yet
    ], "status string, year string, month string, day string, hour string")
    now = F.lit("2026-03-02 10:00:00").cast("timestamp_ntz")
    got = sorted((r["status"], r["day"]) for r in archive_expired(parts, now).collect())
    assert got == [("accepted", "02"), ("duplicate", "01"), ("raw", "16")]


def test_success_rate_only_when_processed(spark):
    from adsieve.operators.metrics import success_rate
    m = spark.createDataFrame([(0, 5), (3, 1)], "total_processed long, total_failed long")
    got = [r["success_rate"] for r in success_rate(m).orderBy("total_processed").collect()]
    assert got == [None, 75.0]
