"""The collector stream, and the maintained newest row per campaign."""

import glob
import os
import random
import tempfile

import datetime as dt
from pyspark.sql import functions as F

from adsieve.operators import ingest as I
from adsieve.operators import latest as L
from adsieve.operators import stats as S
from adsieve.sources import fixtures as FX
from adsieve.streaming import collector as C
from paths import SF001


def _requests(spark):
    one = FX.request_bodies(spark, SF001).where("seq < 500").select(F.col("seq").alias("id"), F.lit("single").alias("kind"), *C.HEADERS)
    many = FX.batch_bodies(spark, SF001, 20).select((F.col("batch_id") + 10_000).cast("long").alias("id"), F.lit("batch").alias("kind"), *C.HEADERS)
    return one.unionByName(many)


def test_collector_stream_answers_and_publishes_once(spark):
    root = tempfile.mkdtemp(prefix="adsieve-collect-", dir="/tmp")
    requests = _requests(spark)
    land, out = f"{root}/in", C.CollectorOutputs(f"{root}/out")
    os.makedirs(land)
    halves = [requests.where("id % 2 = 0"), requests.where("id % 2 = 1 or id % 10 = 0")]  # some requests land twice
    for k, part in enumerate(halves):
        part.coalesce(1).write.parquet(f"{root}/p{k}")
        os.link(glob.glob(f"{root}/p{k}/*.parquet")[0], f"{land}/part-{k}.parquet")
        # the second run restarts from the checkpoint
        C.start_collector(C.read_request_files(spark, land, 1), out, f"{root}/ckpt", {"availableNow": True}).awaitTermination(300)
    single, batch = C.collect_requests(requests)
    assert sorted(map(tuple, C.read_acks(spark, out).collect()), key=str) == sorted(map(tuple, C.acknowledgements(single, batch).collect()), key=str)
    got, want = (sorted(map(tuple, df.collect())) for df in (C.read_topic(spark, out), C.topic_rows(single, batch)))
    assert got == want and len(want) > 500
    # the same answers as the operators give for stored requests
    one = FX.request_bodies(spark, SF001).where("seq < 500")
    acks = {r.seq: (r.ack_status, r.error) for r in I.normalize_bodies(one).collect()}
    assert {r.id: (r.ack_status, r.error) for r in C.read_acks(spark, out).where("kind = 'single'").collect()} == acks
    # a replayed micro-batch overwrites its own files
    n = len(glob.glob(f"{out.topic}/batch_id=*/"))
    assert n == 2


def test_collector_forgets_ids_behind_the_watermark(spark):
    root = tempfile.mkdtemp(prefix="adsieve-collect-", dir="/tmp")
    requests = _requests(spark).where("kind = 'single'").limit(50)
    requests.coalesce(1).write.parquet(f"{root}/a")
    os.makedirs(f"{root}/in")
    for k in range(2):
        os.link(glob.glob(f"{root}/a/*.parquet")[0], f"{root}/in/part-{k}.parquet")
    out = C.CollectorOutputs(f"{root}/out")
    C.start_collector(C.read_request_files(spark, f"{root}/in", 1), out, f"{root}/ckpt", {"availableNow": True}, within="60 days").awaitTermination(300)
    assert C.read_acks(spark, out).count() == 50


def test_latest_row_after_any_batch_order(spark):
    rnd = random.Random(4)
    hours = [dt.datetime(2024, 3, 1) + dt.timedelta(hours=h) for h in range(6)]
    rows = [(f"c{rnd.randint(0, 7)}", rnd.choice(hours), rnd.randint(0, 3), rnd.randint(0, 3), rnd.randint(0, 3), b) for b in range(6) for _ in range(12)]
    df = spark.createDataFrame(rows, "campaign_id string, hour_bucket timestamp_ntz, total_impressions long, total_clicks long, total_conversions long, b int")
    fields = ["campaign_id", "hour_bucket", *L.COUNTS]
    want = sorted(map(tuple, S.latest_by_campaign(S.merge_stats(df)).select(*fields).collect()))
    for order in ([0, 1, 2, 3, 4, 5], [5, 3, 0, 4, 2, 1]):
        root = tempfile.mkdtemp(prefix="adsieve-latest-", dir="/tmp")
        for b in order:
            assert L.add(spark, root, df.where(F.col("b") == b), b)
            assert not L.add(spark, root, df.where(F.col("b") == b), b)  # a replay
        assert sorted(map(tuple, L.read(spark, root).select(*fields).collect())) == want
        assert len(glob.glob(f"{root}/version=*")) == L.KEPT
    one = L.lookup(spark, root, "c3")
    assert tuple(one.select(*fields).first()) == next(w for w in want if w[0] == "c3")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan  # one bucket is read
    assert L.held(spark, root)[1] == [[0, 5]] and L.with_batch([[0, 2], [5, 5]], 4) == [[0, 2], [4, 5]]
    assert L.lookup(spark, root, "none").count() == 0
