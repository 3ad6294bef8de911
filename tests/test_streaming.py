"""Streaming chain == batch job on the same messages, across triggers and a
restart from the checkpoint."""

import dataclasses
import os
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from adsieve.config import FIXTURE_SCORING
from adsieve.operators.classify import classify
from adsieve.operators.decode import decode_messages, to_raw_event
from adsieve.operators.metrics import PipelineReport
from adsieve.plans.batch_job import Outputs, run_batch
from adsieve.sinks.writers import read_stats
from adsieve.sources import fixtures as FX
from adsieve.sources.tables import read_raw_events
from adsieve.streaming import job
from adsieve.streaming.metrics import MetricsListener
from paths import SF001


@pytest.mark.parametrize("windows", ["shared", "store"])
def test_stream_matches_batch(spark, windows):
    root = tempfile.mkdtemp(prefix="adsieve-stream-", dir="/tmp")
    src = os.path.join(root, "in")
    msgs = FX.kafka_messages(spark, SF001)
    # two landed files, split by arrival: two triggers
    cut = msgs.select(F.percentile_approx("seq", 0.5)).first()[0]
    msgs.where(F.col("seq") <= cut).coalesce(1).write.parquet(os.path.join(src, "a"))
    msgs.where(F.col("seq") > cut).coalesce(1).write.parquet(os.path.join(src, "b"))
    files = sorted(os.path.join(dp, f) for dp, _, fs in os.walk(src) for f in fs if f.endswith(".parquet"))
    land = os.path.join(root, "landed")
    os.makedirs(land)
    out = Outputs(os.path.join(root, "out"))
    ckpt = os.path.join(root, "ckpt")
    # first run sees the first file only, second run (restart) the second
    os.link(files[0], os.path.join(land, "part-0.parquet"))
    listener, report = MetricsListener(), PipelineReport()
    spark.streams.addListener(listener)
    how = {"trigger": {"availableNow": True}, "windows": windows, "report": report}
    q = job.start(job.read_message_files(spark, land), out, ckpt, FIXTURE_SCORING, **how)
    q.awaitTermination(300)
    os.link(files[1], os.path.join(land, "part-1.parquet"))
    q = job.start(job.read_message_files(spark, land), out, ckpt, FIXTURE_SCORING, **how)
    q.awaitTermination(300)
    # batch reference over the same messages, arrival-ordered
    ev = to_raw_event(decode_messages(msgs))
    ref = classify(ev, dataclasses.replace(FIXTURE_SCORING, arrival_col="arrival"))
    want = {r["status"]: r["count"] for r in ref.groupBy("status").count().collect()}
    raw = read_raw_events(spark, out.raw_events)
    assert raw.count() == want["accepted"]
    st = read_stats(spark, out.stats_delta).agg(F.sum("total_impressions"), F.sum("total_clicks"),
                                                 F.sum("total_conversions")).first()
    ref_acc = ref.where("status = 'accepted'")
    want_st = ref_acc.agg(F.count_if(F.col("event_type") == "impression"), F.count_if(F.col("event_type") == "click"),
                          F.count_if(F.col("event_type") == "conversion")).first()
    assert tuple(st) == tuple(want_st)
    if windows == "store":
        for _ in range(50):  # listener events arrive asynchronously
            if sum(b["processed"] for b in listener.batches) == want["accepted"]:
                break
            time.sleep(0.2)
        tot = listener.totals()
        assert tot["processed"] == want["accepted"]
        assert tot["duplicates"] == want.get("duplicate", 0) and tot["fraud"] == want.get("fraud", 0)
    spark.streams.removeListener(listener)
    tot = report.totals()
    assert (tot["total_processed"], tot["total_duplicates"], tot["total_fraud"]) == (want["accepted"], want.get("duplicate", 0), want.get("fraud", 0))
    assert tot["avg_seconds_per_event"] > 0 and tot["last_processed_at"] == ref.where("status = 'accepted'").agg(F.max("arrival")).first()[0].isoformat()
    # rejected events are quarantined, not dropped (no storage violations here)
    assert spark.read.parquet(out.quarantine).count() == ev.count() - ref.count()
    arch = spark.read.text(out.archive)
    assert arch.where("status = 'duplicate'").count() == want.get("duplicate", 0)
    assert arch.where("status = 'fraud'").count() == want.get("fraud", 0)
    if windows == "shared":  # a batch after the stream continues its marks
        again = run_batch(spark, msgs, out, 50, cfg=FIXTURE_SCORING)
        assert again.where("status in ('accepted', 'fraud')").count() == 0
        assert again.where("status = 'duplicate'").count() == ref.count()


def test_stateful_anchored_random_two_triggers(spark):
    """Stream form == sequential reference on random keys/times (ties at
    t0 + W included), with window state carried across two triggers."""
    import random

    from brute import anchored
    from adsieve.streaming.anchored_state import stateful_anchored

    spark.conf.set("spark.sql.streaming.stateStore.providerClass", job.ROCKSDB)
    rnd = random.Random(11)
    rows = [(o, rnd.choice(["a", "b", "hot", "hot"]), rnd.randint(0, 3000)) for o in range(600)]
    # trigger 1: the first 300 by arrival; trigger 2: the rest
    rows.sort(key=lambda r: (r[2], r[0]))
    root = tempfile.mkdtemp(prefix="adsieve-sa-", dir="/tmp")
    land = os.path.join(root, "in")
    schema = "seq long, k string, t long"
    base = 1_700_000_000
    for i, part in enumerate((rows[:300], rows[300:])):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(os.path.join(root, f"p{i}"))
    files = [next(os.path.join(dp, f) for dp, _, fs in os.walk(os.path.join(root, f"p{i}")) for f in fs
                  if f.endswith(".parquet")) for i in range(2)]
    os.makedirs(land)
    sink = os.path.join(root, "out")
    ckpt = os.path.join(root, "ckpt")
    for i in range(2):
        os.link(files[i], os.path.join(land, f"part-{i}.parquet"))
        src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(land)
        src = src.withColumn("arrival", F.timestamp_seconds(F.col("t") + base).cast("timestamp_ntz"))
        out = stateful_anchored(src, "k", 100, F.lit(True), "pos", ts="arrival", order="seq", ttl_ms=3_600_000)
        q = (out.select("seq", "pos").writeStream.format("parquet").option("path", sink)
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
        q.awaitTermination(300)
    got = {r["seq"]: r["pos"] for r in spark.read.parquet(sink).collect()}
    want = anchored([(k, t, o) for o, k, t in rows], 100)
    assert got == {o: p for o, (p, _) in want.items()}
