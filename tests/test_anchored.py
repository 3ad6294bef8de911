"""Anchored windows: distributed form == sequential reference."""

import random

import pytest
from pyspark.sql import functions as F

from brute import anchored
from adsieve.operators.anchored import anchored_positions

BASE = 1_700_000_000  # seconds


def _naive(sec):
    import datetime as dt
    return dt.datetime(1970, 1, 1) + dt.timedelta(seconds=sec)


def _frame(spark, rows):
    data = [(k, BASE + t, o, c) for k, t, o, c in rows]
    df = spark.createDataFrame(data, "k string, ts_s long, seq long, counted boolean")
    return df.withColumn("created_at", F.timestamp_seconds("ts_s").cast("timestamp_ntz"))


def _check(spark, rows, window, parts):
    df = _frame(spark, rows)
    out = anchored_positions(df, "k", window, counted=F.col("counted"), pos_col="pos",
                             anchor_col="anchor_ts", parts=parts)
    got = {r["seq"]: (r["pos"], r["anchor_ts"]) for r in out.select("seq", "pos", "anchor_ts").collect()}
    want = anchored([(k, t, o) for k, t, o, c in rows if c], window)
    for k, t, o, c in rows:
        if not c:
            assert got[o] == (None, None)
        else:
            pos, anchor = want[o]
            assert got[o][0] == pos, (o, got[o], want[o])
            assert got[o][1] == _naive(BASE + anchor), (o, got[o], want[o])


@pytest.mark.parametrize("parts", [1, 2, 5, 16, 64])
def test_random_keys(spark, parts):
    rnd = random.Random(parts)
    rows = []
    for o in range(3000):
        k = rnd.choice(["hot"] * 6 + ["a", "b", "c", "", None])
        t = rnd.randint(0, 4000)
        rows.append((k, t, o, rnd.random() > 0.1 and k is not None))
    _check(spark, rows, 100, parts)


def test_ties_at_window_edge(spark):
    # events exactly at t0 + W open a new window; equal timestamps break on seq
    rows = [("k", 0, 1, True), ("k", 0, 2, True), ("k", 10, 3, True), ("k", 10, 4, True),
            ("k", 20, 5, True), ("k", 19, 6, True), ("k", 30, 7, True), ("k", 40, 8, True)]
    _check(spark, rows, 10, 1)
    _check(spark, rows, 10, 3)


def test_periodic_chains_never_merge(spark):
    # spacing just over W/2: chains from different entries stay apart
    rows = [("p", i * 51, i, True) for i in range(400)]
    _check(spark, rows, 100, 2)
    _check(spark, rows, 100, 7)


def test_tiny_arrow_batches(spark):
    # chunks straddle Arrow batches: the carried-over scan must agree
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rnd = random.Random(7)
        rows = [(rnd.choice(["hot", "hot", "a", None]), rnd.randint(0, 3000), o, True) for o in range(1500)]
        rows = [(k, t, o, k is not None) for k, t, o, _ in rows]
        for cw in (1, 3, 16):
            _check(spark, rows, 100, cw)
        dense = [("d", i // 3, i, True) for i in range(1200)]  # ties and dense chains
        _check(spark, dense, 50, 2)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_walk_sorted_matches_reference():
    import numpy as np
    from adsieve.operators.anchored import walk_sorted
    rnd = random.Random(3)
    for _ in range(200):
        t = np.sort(np.array([rnd.randint(0, 500) for _ in range(rnd.randint(0, 40))], dtype=np.int64))
        # resume from a live window (anchor a, count n) or start fresh
        fresh = rnd.random() < 0.5
        a0, n0 = (None, 0) if fresh else (rnd.randint(-100, 50), rnd.randint(1, 5))
        want, anchor, count = [], a0, n0
        for x in t:
            if anchor is None or x >= anchor + 60:
                anchor, count = int(x), 0
            count += 1
            want.append((count, anchor))
        pos, anc, la, ln = walk_sorted(t, None if fresh else a0 + 60, n0, 60)
        assert list(zip(pos.tolist(), anc.tolist())) == want
        if len(t):
            assert (ln, la) == want[-1]




def test_small_segments(spark, monkeypatch):
    # slices and chains that go on from one Arrow batch and one segment to the next
    from adsieve.operators import anchored as A
    monkeypatch.setattr(A, "_SEGMENT", 5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        rnd = random.Random(11)
        rows = [(rnd.choice(["hot", "hot", "hot", "a", "b"]), rnd.randint(0, 2500), o, True) for o in range(1200)]
        for parts in (1, 4, 20):
            _check(spark, rows, 100, parts)
        _check(spark, [("p", i * 51, i, True) for i in range(400)], 100, 4)
        _check(spark, [("q", i * 7 + (i % 3), i, True) for i in range(900)], 40, 8)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_negative_times_and_gaps_of_a_window(spark):
    rows = [("k", t, o, True) for o, t in enumerate([-250, -200, -101, -100, -1, 0, 99, 100, 199, 200, 201, 300, 399, 400])]
    for parts in (1, 4, 50):
        _check(spark, [(k, t - BASE, o, c) for k, t, o, c in rows], 100, parts)


def test_a_hot_window_is_shared(spark):
    """One key, 600,000 events at distinct microseconds in three windows."""
    import numpy as np
    from adsieve.operators.anchored import anchored_positions, walk_sorted
    n, W = 600_000, 20
    df = spark.range(0, n, 1, 8).select(F.col("id").alias("seq"), F.lit("hot").alias("k"), F.pmod(F.xxhash64("id"), F.lit(3 * W * 10 ** 6)).alias("us")) \
        .withColumn("created_at", F.timestamp_add("MICROSECOND", F.col("us"), F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        out = anchored_positions(df, "k", W, parts=16).withColumn("task", F.spark_partition_id())
        got = out.select("us", "seq", "pos", "task", F.timestamp_diff("MICROSECOND", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"), F.col("anchor_ts")).alias("a")).toPandas()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    got = got.sort_values(["us", "seq"])
    pos, anchor, _, _ = walk_sorted(got["us"].to_numpy(), None, 0, W * 10 ** 6)
    assert (got["pos"].to_numpy() == pos).all() and (got["a"].to_numpy() == anchor).all()
    first_window = got[got["a"] == anchor[0]]
    assert first_window["task"].nunique() >= 8 and first_window["task"].value_counts().max() < len(first_window) / 4
    assert len(np.unique(anchor)) == 3


def test_twenty_million_events_in_one_window(spark):
    """One key, one window; the times are a permutation, so a row's position is known."""
    from adsieve.operators.anchored import anchored_positions
    n = 20_000_000
    df = spark.range(0, n, 1, 8).select(F.col("id").alias("seq"), F.lit("hot").alias("k"), F.pmod(F.col("id") * 7919, F.lit(n)).alias("us")) \
        .withColumn("created_at", F.timestamp_add("MICROSECOND", F.col("us"), F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        parts = anchored_positions(df, "k", 20, parts=64).groupBy(F.spark_partition_id()).agg(
            F.count(F.lit(1)).alias("rows"), F.count_if(F.col("pos") != F.col("us") + 1).alias("wrong")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert sum(r["rows"] for r in parts) == n and not any(r["wrong"] for r in parts)
    assert len(parts) >= 16 and max(r["rows"] for r in parts) <= n / 8
