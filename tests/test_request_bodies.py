"""Request bodies as text: what is answered, and what is published."""

import datetime as dt

from adsieve import config as C
from adsieve.operators import ingest as I

NOW = dt.datetime(2026, 5, 1, 9, 30)
HEADERS = "seq long, xff string, x_real_ip string, remote_ip string, received_at timestamp_ntz, body string"


def test_single_bodies(spark):
    bodies = [
        '{"event_type":"click","user_id":"u","campaign_id":"c","created_at":"2026-04-30T23:59:59.5+02:00","meta_data":{"b":1}}',
        '{"Event_Type":"click","USER_ID":"u","campaign_id":"c"}',
        '{"event_type":"click","user_id":"u"}', "null", "", None, "[]", '{"user_id":5}', '{"created_at":"today"}', '{"meta_data":[]}', "{}x"]
    df = spark.createDataFrame([(k, "", "", "10.1.1.1", NOW, b) for k, b in enumerate(bodies)], HEADERS)
    got = {r["seq"]: r for r in I.normalize_bodies(df).collect()}
    assert [got[k]["error"] for k in range(len(bodies))] == [None, None, C.ERR_REQUIRED, C.ERR_REQUIRED] + [C.ERR_BAD_BODY] * 7
    assert got[0]["created_at"] == dt.datetime(2026, 4, 30, 23, 59, 59, 500000) and got[0]["created_offset"] == "+02:00"
    assert got[0]["meta_data"] == '{"b":1}' and got[0]["ip_address"] == "10.1.1.1"
    assert got[1]["created_at"] == NOW and len(got[1]["event_id"]) == 36 and got[1]["user_id"] == "u"


def test_batch_bodies(spark):
    one = '{"event_type":"click","user_id":"u","campaign_id":"c"}'
    bodies = [f"[{one}, {one}]", "[]", "null", "[null]", "[7]", f"[{one},{{\"user_id\":1}}]", one, "", None, "[" + ",".join([one] * 1001) + "]", f"[{one}] x"]
    df = spark.createDataFrame([(k, "", "", "10.1.1.1", NOW, b) for k, b in enumerate(bodies)], HEADERS).withColumnRenamed("seq", "batch_id")
    parsed = I.parse_batch_bodies(df)
    acks = {r["batch_id"]: (r["ack_status"], r["error"], r["n_events"]) for r in I.batch_ack(parsed).collect()}
    bad = (None, C.ERR_BAD_BODY, None)
    assert acks == {0: ("queued", None, 2), 1: (None, C.ERR_BATCH_EMPTY, None), 2: (None, C.ERR_BATCH_EMPTY, None), 3: ("queued", None, 1),
                    4: bad, 5: bad, 6: bad, 7: bad, 8: bad, 9: (None, C.ERR_BATCH_TOO_BIG, None), 10: bad}
    rows = I.explode_batches(parsed).orderBy("batch_id", "position").collect()
    assert [(r["batch_id"], r["position"], r["user_id"]) for r in rows] == [(0, 0, "u"), (0, 1, "u"), (3, 0, "")]
    assert all(r["created_at"] == NOW and r["ip_address"] == "10.1.1.1" for r in rows) and len({r["event_id"] for r in rows}) == 3
