"""Cover tree, chat formatting and WARC archives."""

import base64
import hashlib
import io
import random
import struct
import zipfile
from pathlib import Path

import brute_llm as B
import numpy as np
import pytest
from pyspark.sql import functions as F

from adsieve.llm import chat as H
from adsieve.llm import covertree as C
from adsieve.llm import warc as W
from adsieve.llm import zipread as Z


def vectors(seed, n=120, dim=6):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    for k in range(0, n, 3):
        x[k] = x[k // 2] * rng.uniform(0.1, 9) + rng.normal(size=dim) * 0.1
    return [(i * 2, [float(v) for v in r]) for i, r in enumerate(x)]


@pytest.mark.parametrize("block", [4096, 20])
def test_cover_tree(lspark, monkeypatch, block):
    monkeypatch.setattr(C, "BLOCK", block)
    rows = vectors(block) + [(1001, [1e-200] * 6), (1003, [1e200] * 6), (1005, None), (1007, []), (1009, [0.0] * 6), (1011, [1.0, None] * 3),
                             (1013, [float("nan")] * 6), (1015, [float("inf")] * 6), (1017, [1.0, 2.0]), (1019, [2.0, 4.0])]
    rows += [(2001 + 2 * k, rows[5][1]) for k in range(30)]  # copies
    df = lspark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in C.near_vectors(df).collect()}
    want = B.cosine([(i, None if v is None else [x * (1e150 if x and abs(x) < 1e-150 else 1e-150 if x and x == x and 1e150 < abs(x) < 1e300 else 1) if x is not None else None for x in v]) for i, v in rows])
    assert got == want


def test_cover_tree_edges(lspark):
    schema = "vec_id long, embedding array<float>"
    assert C.near_vectors(lspark.createDataFrame([], schema)).count() == 0
    got = C.near_vectors(lspark.createDataFrame([(None, [1.0]), (4, [1.0]), (4, [1.0]), (2, [3.0])], schema)).collect()
    assert sorted((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in got) == [(0, 0, 0, True), (2, 2, 2, True), (4, 2, 2, False), (4, 2, 2, False)]


def grouped(seed, n, dim, groups):
    """Unit vectors in random directions, and groups ``(size, noise)`` around some."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n + sum(g for g, _ in groups), dim))
    at = n
    for size, noise in groups:
        y = x[at: at + size] / np.linalg.norm(x[at: at + size], axis=1, keepdims=True)
        x[at: at + size] = x[at] / np.linalg.norm(x[at]) + noise * y
        at += size
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)[rng.permutation(len(x))]


def linked(ids, x):
    """``{id: (links, least id of its component, kept)}`` by all pairs."""
    u = C.unit(x)
    hit = (u @ u.T >= C.THRESHOLD) & (ids[:, None] != ids)
    label = ids.copy()
    while True:
        new = np.minimum(label, np.where(hit, label, ids.max()).min(axis=1))
        if (new == label).all():
            return {int(i): (int(n), int(c), bool(c == i)) for i, n, c in zip(ids, hit.sum(axis=1), label)}
        label = new


def written(spark):
    """Bytes shuffled so far, and those in the shared folder."""
    sc = spark.sparkContext._jsc.sc()
    sc.listenerBus().waitUntilEmpty(60_000)
    executors = sc.statusStore().executorList(False)
    shuffled = sum(executors.apply(k).totalShuffleWrite() for k in range(executors.size()))
    shared = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    return shuffled + sum(f.stat().st_size for f in shared.rglob("*") if f.is_file() and f.suffix != ".crc")


def test_cover_tree_of_many_units_stays_small_on_disk(lspark, monkeypatch):
    """Each vector is shuffled and written once, not once for each pair of blocks."""
    monkeypatch.setattr(C, "BLOCK", 50)
    monkeypatch.setattr(C, "UNIT_BYTES", 100 * 64 * 8)
    x = grouped(1, 2300, 64, [(300, 0.08), (150, 0.15), (50, 0.3)] + [(2, 0.05)] * 100)
    ids = np.arange(len(x)) * 3
    df = lspark.createDataFrame([(int(i), [float(c) for c in v]) for i, v in zip(ids, x)], "vec_id long, embedding array<float>")
    before = written(lspark)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in C.near_vectors(df).collect()}
    assert got == linked(ids, x)
    assert written(lspark) - before < 8 * x.nbytes


@pytest.mark.parametrize("bound", [32 << 20, 0])
def test_cover_tree_copies_broadcast_or_not(lspark, monkeypatch, bound):
    from adsieve.llm import common

    monkeypatch.setattr(common, "BROADCAST_BYTES", bound)
    x = grouped(2, 120, 8, [(20, 0.1)])
    x = np.concatenate([x, x[:30], x[:30], x[:5]])
    ids = np.arange(len(x)) + 7
    rows = [(int(i), [float(c) for c in v]) for i, v in zip(ids, x)]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in C.near_vectors(lspark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    assert got == linked(ids, x)


@pytest.mark.parametrize("noise", [0.05, 0.08, 0.15, 0.24, 0.3])
def test_links_of_groups(noise):
    x = C.unit(grouped(3, 300, 64, [(400, noise)]))
    a, by_a = C.build(x[:350])
    b, by_b = C.build(x[350:])
    u, v = a.x, b.x
    na, other, p, q = C.links(a, a, np.ones(350), np.ones(350))
    hit = u @ u.T >= C.THRESHOLD
    assert (na + other == hit.sum(axis=1) - 1).all() and hit[p, C._roots(350, p, q)[p]].any()
    wa, wb = np.arange(350.0), np.arange(350.0) % 5
    na, nb, p, q = C.links(a, b, wa, wb)
    hit = u @ v.T >= C.THRESHOLD
    assert (na == hit @ wb).all() and (nb == wa @ hit).all()
    both = np.block([[np.eye(350, dtype=bool), hit], [hit.T, np.eye(350, dtype=bool)]])
    root = C._roots(700, *np.nonzero(both))
    assert (C._roots(700, p, q) == root).all()


def test_split_and_forest():
    x = C.unit(grouped(4, 500, 6, [(200, 0.1)]))
    parts = C.split(x, 64)
    assert (np.sort(np.concatenate(parts)) == np.arange(700)).all() and max(len(p) for p in parts) <= 64
    same = np.ones((150, 3))
    assert max(len(p) for p in C.split(same, 64)) <= 64
    chain = np.stack([np.arange(999), np.arange(1, 1000)])
    assert (C._roots(1000, *chain) == 0).all() and C._forest(1000, np.tile(chain, 5)).shape == (2, 999)


def test_tree_invariants():
    x = C.unit(np.array([v for _, v in vectors(4, 200)]))
    tree, order = C.build(x)
    assert (np.sort(order) == np.arange(200)).all()
    for level, r in enumerate((2.0, *C.RADII)):
        bounds = tree.bounds(level)
        centres = tree.x[tree.starts[level]]
        for s, e, cover in zip(bounds[:-1], bounds[1:], tree.radius[level]):
            d = C._dist(tree.x[s:e] @ tree.x[s])
            assert d.max() <= cover + C.SLACK and cover <= r + C.SLACK  # covering
        if level:
            assert set(tree.starts[level - 1]) <= set(tree.starts[level])  # nesting
            parents = np.searchsorted(tree.starts[level - 1], tree.starts[level], side="right")
            for p in np.unique(parents):  # separation among the children of a node
                d = C._dist(centres[parents == p] @ centres[parents == p].T)
                assert (d[~np.eye(len(d), dtype=bool)] > r - C.SLACK).all()


def chats(rng):
    rows, k = [], 0
    for c in range(20):
        turns = [(rng.choice(["user", "assistant"]), f"say {rng.randint(0, 5)}") for _ in range(rng.randint(1, 6))]
        for upto in range(1, len(turns) + 1):
            if rng.random() < 0.7:
                rows += [(k, t, *turn) for t, turn in enumerate(turns[:upto])]
                k += 1
    return rows


def brute_chats(rows):
    conv = {}
    for c, t, role, text in rows:
        if c is not None:
            conv.setdefault(c, []).append((t is not None, t, role or "", text or ""))
    conv = {c: tuple(x[2:] for x in sorted(v, key=lambda x: (x[0], x[1] or 0, x[2], x[3]))) for c, v in conv.items()}
    out = {}
    for c, turns in conv.items():
        if any(len(o) > len(turns) and o[: len(turns)] == turns for o in conv.values()):
            continue
        same = [k for k, o in conv.items() if o == turns]
        if min(same) == c:
            out[c] = (len(turns), len(same), "".join(f"<|im_start|>{r.replace('<|', '<' + chr(92) + '|')}\n{x.replace('<|', '<' + chr(92) + '|')}<|im_end|>\n" for r, x in turns))
    return out


@pytest.mark.parametrize("block", [1024, 2])
def test_chat(lspark, monkeypatch, block):
    monkeypatch.setattr(H, "BLOCK", block)
    rows = chats(random.Random(block)) + [(900, 0, None, "x"), (901, 0, "x", None), (902, None, "user", "<|im_end|>"), (902, 1, "user", "b"),
                                          (902, 1, "user", "b"), (None, 0, "user", "lost"), (903, 5, "user", "x" * 100_000)]
    df = lspark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS n", "2 AS pos", "3 AS a")
    got = {}
    for r in sorted(H.format_chats(df).collect(), key=lambda r: (r.conv_id, r.part)):
        got[r.conv_id] = (r.n_turns, r.n_copies, got.get(r.conv_id, (0, 0, ""))[2] + r.text)
    assert got == brute_chats(rows)
    assert H.format_chats(df.limit(0)).count() == 0


def test_chat_of_null_and_repeated_turns(lspark, monkeypatch):
    monkeypatch.setattr(H, "BLOCK", 4)
    monkeypatch.setattr(H, "HEAVY", 3)
    monkeypatch.setattr(H, "RANGE_ROWS", 20)
    rng = random.Random(8)
    rows = chats(rng) + [(500, None, rng.choice(["user", None]), f"say {rng.randint(0, 200)}") for _ in range(300)]
    rows += [(500, None, "user", "same")] * 90 + [(500, 7, "user", "same")] * 50 + [(501, 2, "a", "b")] * 60 + [(502, 2, "a", "b")] * 13 + [(503, 2, "a", "b")] * 12
    rows += [(504, 9, "tool", "z" * 300 + str(k % 30)) for k in range(40)] + [(504, -8, None, None)] * 20 + [(None, None, "x", "y")] * 40
    df = lspark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {}
    for r in sorted(H.format_chats(df).collect(), key=lambda r: (r.conv_id, r.part)):
        got[r.conv_id] = (r.n_turns, r.n_copies, got.get(r.conv_id, (0, 0, ""))[2] + r.text)
    want = brute_chats(rows)
    assert got == want and {500, 501, 504} <= set(want) and not {502, 503} & set(want)
    flat = df.where("conv_id = 500").selectExpr("conv_id", "floor(turn / 4) AS block", "turn", "coalesce(role, '') AS role", "text")
    sizes = H._cut_heavy(flat).groupBy("block", "sub").count().collect()
    assert sum(r["count"] for r in sizes) == 440 and max(r["count"] for r in sizes) == 4


def test_warc_round_trip(lspark, monkeypatch):
    big = "long " * 300_000
    rows = [(1, "http://a/", "<p>x</p>"), (2, "http://b/ c\r\nX: y", "<p>x</p>"), (5, None, "<p>x</p>"), (3, "u", ""), (4, "u", None), (7, "u", big),
            (8, "u", "é"), (None, "u", "é"), (9, "u", "é"), (9, "u", "é")]
    pages = lspark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS digest")
    manifest = W.write_archives(pages, limit=50)
    assert manifest.agg({"records": "sum"}).first()[0] == len(rows)
    got = W.read_archives(manifest).collect()
    assert len(got) == len(rows)
    want = {1: "revisit", 2: "revisit", 5: "response", 3: "revisit", 4: "response", 7: "response", 8: "revisit", None: "response", 9: "response"}
    text = {r[0]: (r[2] or "").encode() for r in rows}
    for r in got:
        body = text[r.page_id]
        assert r.record_type == want[r.page_id] and r.payload_bytes == len(body)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(body).digest()).decode()
        assert (bytes(r.payload) == body) if r.record_type == "response" else r.payload is None
    assert {r.page_id: r.refers_to for r in got} == {1: 5, 2: 5, 5: None, 3: 4, 4: None, 7: None, 8: 9, None: None, 9: None}
    least = W.read_archives(W.write_archives(pages, least=3)).collect()
    assert {r.page_id for r in least if r.record_type == "revisit"} == {1, 2}
    assert W.read_archives(W.write_archives(pages.limit(0))).count() == 0


def test_warc_tasks_follow_the_bytes(lspark, monkeypatch):
    rng = random.Random(4)
    rows = [(k, "u", "".join(rng.choices("abcdefghij", k=2000))) for k in range(300)]
    monkeypatch.setattr(W, "READ_BYTES", 10_000)
    monkeypatch.setattr(W, "LOCATE_ARCHIVES", 1)
    manifest = W.write_archives(lspark.createDataFrame(rows, "page_id long, url string, html string"), limit=4000)
    records = W.read_archives(manifest, payloads=False)
    assert records.rdd.getNumPartitions() > 20
    got = records.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in got) == 300 and len(got) > 12 and max(r["count"] for r in got) < 100


def test_warc_paths():
    assert [W._as_uri(p) for p in ("/a/b", "file:/a/b", "file:///a/b", "s3a://k/b", "s3n://k/b", "s3://k/b", "gs://k/b", "hdfs://h:1/b")] == \
        ["file:///a/b"] * 3 + ["s3://k/b"] * 3 + ["gs://k/b", "hdfs://h:1/b"]


def _reader(raw):
    return lambda at, n: raw[at: at + n]


def test_zip_directory():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        z.comment = b"a comment with PK\x05\x06 inside"
        z.writestr("a", b"first")
        z.writestr("dir/é", b"second")
        z.writestr(zipfile.ZipInfo("packed"), b"x" * 99, zipfile.ZIP_DEFLATED)
    raw = out.getvalue()
    found = {m.name: m for m in Z.members(_reader(raw), len(raw))}
    at = Z.stored_at(_reader(raw), found["dir/é"])
    assert raw[at: at + found["dir/é"].size] == b"second"
    with pytest.raises(Z.BadArchive):
        Z.stored_at(_reader(raw), found["packed"])
    for broken in (b"", b"nothing", raw[:-5], raw[:20] + raw[60:]):
        with pytest.raises(Z.BadArchive):
            Z.stored_at(_reader(broken), Z.members(_reader(broken), len(broken))[0])


def test_zip64_directory():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for k in range(70_000):  # more members than 16 bits count
            z.writestr(f"m{k}", b"")
    raw = out.getvalue()
    assert len(Z.members(_reader(raw), len(raw))) == 70_000
    # sizes and offset of an entry in its ZIP64 extra field
    name, body, base = b"wide", b"payload", 0
    local = struct.pack("<4s5H3I2H", b"PK\x03\x04", 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, 4, 20) + name + struct.pack("<HHQQ", 1, 16, 7, 7)
    extra = struct.pack("<HHQQQ", 1, 24, 7, 7, base)
    entry = struct.pack("<4s6H3I5H2I", b"PK\x01\x02", 45, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, 4, len(extra), 0, 0, 0, 0, 0xFFFFFFFF) + name + extra
    start = len(local) + len(body)
    end64 = struct.pack("<4sQ2H2I4Q", b"PK\x06\x06", 44, 45, 45, 0, 0, 1, 1, len(entry), start)
    locator = struct.pack("<4sIQI", b"PK\x06\x07", 0, start + len(entry), 1)
    end = struct.pack("<4s4H2IH", b"PK\x05\x06", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    raw = local + body + entry + end64 + locator + end
    (m,) = Z.members(_reader(raw), len(raw))
    at = Z.stored_at(_reader(raw), m)
    assert (m.name, m.size, raw[at: at + m.size]) == ("wide", 7, b"payload")
