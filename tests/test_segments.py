"""Folding of batch folders, and windows carried over batches and streams."""

import dataclasses
import datetime as dt
import glob
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from adsieve.config import FIXTURE_SCORING
from adsieve.operators import archive as A
from adsieve.operators.classify import WindowCounter, WindowScorer, classify
from adsieve.operators.decode import decode_messages, to_raw_event
from adsieve.plans.batch_job import Outputs, run_batch, tables
from adsieve.sinks import segments as G
from adsieve.sinks import writers as W
from adsieve.sources import fixtures as FX
from adsieve.sources.tables import read_archive, read_raw_events
from adsieve.streaming import job
from paths import SF001


def _root(name):
    return tempfile.mkdtemp(prefix=f"adsieve-{name}-", dir="/tmp")


def test_plan_keeps_the_folders_few():
    manifest, batches, most = G.Manifest(), [], 0
    for b in range(1000):
        batches.append(b)
        todo = G.plan(manifest, batches)
        if todo:
            rest = [s for s in manifest.segments if s.name not in todo.inputs]
            hi = todo.output.hi if manifest.folded is None else max(manifest.folded, todo.output.hi)
            manifest = G.Manifest(manifest.version + 1, hi, tuple(sorted([*rest, todo.output], key=lambda s: s.lo)))
        live = [s for s in manifest.segments]
        assert [(x.hi + 1) for x in live[:-1]] == [x.lo for x in live[1:]]  # no gap, no overlap
        most = max(most, len(live) + sum(not manifest.closed(x) for x in batches))
    assert most <= G.FAN * 4 + G.KEEP
    assert G.plan(G.Manifest(), list(range(8))) is None  # the newest stay as they are


def test_a_hundred_batches(spark):
    """Stats and windows of 100 batches: few files, one sum at every moment."""
    out, hour = Outputs(_root("fold")), dt.datetime(2024, 5, 1, 7)
    kept = [t for t in tables(spark, out, {"dedupe": 50}) if t.path in (out.stats_delta, out.windows, out.progress)]
    most = 0
    for b in range(100):
        at = dt.datetime(2024, 5, 1) + dt.timedelta(seconds=10 * b)
        us = int((at - dt.datetime(1970, 1, 1)).total_seconds()) * 1_000_000
        stats = spark.createDataFrame([(f"c{b % 3}", 1, 2, 0, hour)], "campaign_id string, total_impressions long, total_clicks long, total_conversions long, hour_bucket timestamp_ntz")
        W.write_windows({"dedupe": spark.createDataFrame([(f"id{b}", us, 1)], "key string, anchor_us long, n long").coalesce(1)}, out.windows, b)
        W.write_progress(spark.createDataFrame([(0, at)], "source long, arrival timestamp_ntz"), out.progress, b)
        W.write_stats_delta(stats.coalesce(1), out.stats_delta, b)
        before = W.read_stats(spark, out.stats_delta)  # a reader that began before the fold
        G.fold(spark, out.root, kept, G.batches_of(spark, out.stats_delta))
        most = max(most, len(glob.glob(f"{out.root}/*/**/*.parquet", recursive=True)))
        if b % 13 == 0 or b == 99:
            assert before.agg(F.sum("total_impressions")).first()[0] == b + 1
            assert W.read_stats(spark, out.stats_delta).agg(F.sum("total_impressions"), F.sum("total_clicks")).first() == (b + 1, 2 * b + 2)
    assert most <= 3 * 60 and len(glob.glob(f"{out.root}/_manifest/*.json")) <= 4
    manifest = G.load(spark, out.root)
    assert manifest.closed(50) and not manifest.closed(97)
    # closed windows that no event can reach are gone, the others stay
    left = {r.key for r in W.read_windows(spark, out.windows).select("key").collect()}
    assert {f"id{b}" for b in range(96, 100)} <= left and len(left) < 30 and "id0" not in left
    # a fold that died half-way left folders that no reader takes
    W.write_stats_delta(W.read_stats(spark, out.stats_delta), out.stats_delta, "88-99")
    assert W.read_stats(spark, out.stats_delta).agg(F.sum("total_impressions")).first()[0] == 100
    with pytest.raises(RuntimeError):
        G.commit(spark, out.root, manifest)


USERS = WindowScorer((WindowCounter("user", "user_id", lambda cfg: 3600), WindowCounter("ip", "ip_address")),
                     lambda cfg: F.when(F.col("user_pos") > 1, 90).when(F.col("ip_pos") > 4, 85).otherwise(F.lit(10)))
FIELDS = ["seq", "status", "risk_score", "dup_pos", "user_pos", "ip_pos"]


def test_declared_windows_carry_over_batches_folds_and_streams(spark):
    """One batch, four batches with folds in between, both kinds of stream:
    the same answers of a scorer with two counters of its own."""
    msgs = FX.kafka_messages(spark, SF001).where("seq < 600")
    arrival = dataclasses.replace(FIXTURE_SCORING, arrival_col="arrival")
    whole = classify(to_raw_event(decode_messages(msgs)), arrival, scorer=USERS, keep_rejected=True)
    want = sorted(map(tuple, whole.select(*FIELDS).collect()), key=str)
    assert len({w[1] for w in want}) == 4
    cuts = [-1, *msgs.select(F.percentile("seq", F.array(*map(F.lit, (0.25, 0.5, 0.75))))).first()[0], 10 ** 9]
    parts = [msgs.where((F.col("seq") > a) & (F.col("seq") <= b)) for a, b in zip(cuts, cuts[1:])]
    out, got = Outputs(_root("scorer")), []
    fan, keep = G.FAN, G.KEEP
    for k, part in enumerate(parts):
        routed = run_batch(spark, part, out, k + 1, cfg=FIXTURE_SCORING, scorer=USERS, fan=None)
        got += map(tuple, routed.select(*FIELDS).collect())
        G.fold(spark, out.root, tables(spark, out, {"dedupe": arrival.dedupe_ttl_s, "user": 3600, "ip": arrival.ip_window_s}),
               G.batches_of(spark, out.stats_delta), fan=2, keep=1)
    assert sorted(got, key=str) == want and (fan, keep) == (8, 4)
    assert G.load(spark, out.root).folded >= 2
    n = {s: sum(w[1] == s for w in want) for s in ("accepted", "fraud", "duplicate", "rejected")}
    valid = n["accepted"] + n["fraud"] + n["duplicate"]
    stored = whole.where("status = 'accepted'").count()

    def check():
        arch, index = read_archive(spark, out.archive), W.read_archive_index(spark, out.archive_index)
        assert arch.where("status = 'raw'").count() == valid and arch.where("status = 'fraud'").count() == n["fraud"]
        assert {r.status: r.n_records for r in A.archive_counts(index).collect()} == {r.status: r.n_records for r in A.archive_counts(arch).collect()}
        assert read_raw_events(spark, out.raw_events).count() <= stored
        return read_raw_events(spark, out.raw_events).count(), W.read_stats(spark, out.stats_delta).agg(F.sum("total_impressions")).first()[0]

    before = check()
    # a folded batch is closed: its replay changes nothing
    assert run_batch(spark, parts[0], out, 1, cfg=FIXTURE_SCORING, scorer=USERS).count() == 0
    assert check() == before
    plan = A.archive_expired(W.read_archive_index(spark, out.archive_index), F.lit("2030-01-01").cast("timestamp_ntz"))
    assert plan.count() > 0 and not [f for f in plan.inputFiles() if ".gz" in f]
    for windows in ("shared", "store"):
        land, to = _root("land"), Outputs(_root("scorer-stream"))
        for k, part in enumerate([parts[0], msgs.where(F.col("seq") > cuts[1])]):
            part.coalesce(1).write.parquet(f"{land}/p{k}")
        os.makedirs(f"{land}/in")
        for k in range(2):
            os.link(glob.glob(f"{land}/p{k}/*.parquet")[0], f"{land}/in/part-{k}.parquet")
            os.utime(f"{land}/in/part-{k}.parquet", (1_700_000_000 + k, 1_700_000_000 + k))
        q = job.start(job.read_message_files(spark, f"{land}/in"), to, f"{land}/ckpt", FIXTURE_SCORING, trigger={"availableNow": True},
                      scorer=USERS, windows=windows)
        q.awaitTermination(300)
        arch = read_archive(spark, to.archive)
        assert {s: arch.where(F.col("status") == s).count() for s in ("raw", "accepted", "fraud", "duplicate")} == \
            {"raw": valid, **{s: n[s] for s in ("accepted", "fraud", "duplicate")}}
    with pytest.warns(UserWarning, match="keeps no state"):
        run_batch(spark, parts[2], out, 9, cfg=FIXTURE_SCORING, scorer=lambda df, cfg: df.withColumn("risk_score", F.lit(1)), fan=None)


def test_late_rows_join_the_open_window(spark):
    """A later batch brings earlier times (another source partition): they fall
    into the window that is open, and are not lost."""
    def messages(rows):
        body = F.concat(F.lit('{"event_id":"'), F.col("id"), F.lit('","event_type":"click","user_id":"u","campaign_id":"c","geo_country":"US","device_type":"m","ip_address":"'), F.col("ip"), F.lit('"}'))
        df = spark.createDataFrame(rows, "seq long, s long, id string, ip string")
        return df.select("seq", F.lit("k").alias("key"), F.timestamp_add("SECOND", F.col("s"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).alias("arrival"), body.alias("value"))

    cfg = dataclasses.replace(FIXTURE_SCORING, dedupe_ttl_s=100, ip_window_s=100, ip_threshold=3)
    out, far = Outputs(_root("late")), 1 << 48
    first = run_batch(spark, messages([(0, 50, "a", "x"), (1, 60, "b", "x")]), out, 1, cfg=cfg)
    second = run_batch(spark, messages([(far, 20, "a", "x"), (far + 1, 30, "c", "x"), (far + 2, 40, "d", "y"), (2, 151, "a", "x")]), out, 2, cfg=cfg)
    got = {r.seq: (r.status, r.dup_pos, r.ip_pos) for r in first.unionByName(second).collect()}
    assert got == {0: ("accepted", 1, 1), 1: ("accepted", 1, 2), far: ("duplicate", 2, None), far + 1: ("accepted", 1, 3),
                   far + 2: ("accepted", 1, 1), 2: ("accepted", 1, 1)}
