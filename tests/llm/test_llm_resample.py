"""Importance resampling against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from adsieve.llm import resample as R

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(ASCII_LOWER))
    return len(w), [" ".join(w[i: i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def bucket(feature):
    return zlib.crc32(feature.encode()) % R.BUCKETS


def brute(rows, target, percent):
    s = Counter(bucket(f) for _, t in rows for f in grams(t)[1])
    t = Counter(bucket(f) for x in target for f in grams(x)[1])
    S, T = float(sum(s.values())), float(sum(t.values()))
    out = []
    for i, text in rows:
        n, fs = grams(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1.0) * (S + R.BUCKETS) / ((s[b] + 1.0) * (T + R.BUCKETS)))) for b in map(bucket, fs))
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    fit = sorted((r for r in out if r[5] >= R.LEAST_WORDS), key=lambda r: (-r[3], r[0] is None, r[0], r[1]))
    for k, r in enumerate(fit[: percent * len(fit) // 100]):
        r[4] = k + 1
    return sorted((tuple(r) for r in out), key=str)


def corpus(seed, n):
    rng = random.Random(seed)
    vocab = ["Alpha", "beta2", "ÉCOLE", "école", "漢字", "x" * 40, "a_b", "don't", "Z", "9", "straße weg", " "]
    rows = [(k * 7 % 101, " ".join(rng.choice(vocab) for _ in range(rng.randint(0, 60)))) for k in range(n)]
    return rows + [(500, None), (501, ""), (502, " .,;\n"), (None, "no id " * 30), (None, "no id " * 30), (503, "same " * 25), (503, "same " * 25),
                   (504, "one two"), (505, "q" * 5000), (506, ("w" * 1500 + " ") * 25)]


@pytest.mark.parametrize("limit, matrix", [(1 << 21, 8 << 20), (90, 100)])
def test_scores(documents, lspark, monkeypatch, limit, matrix):
    monkeypatch.setattr(R, "SLICE_BYTES", limit)
    monkeypatch.setattr(R, "MATRIX_BYTES", matrix)
    monkeypatch.setattr(R, "RANK_ROWS", 5)
    rows, target = corpus(limit, 90), ["alpha beta2 école", None, "漢字 Z 9 Z 9", ""]
    docs = documents(rows, row="clash", rank=3, score="s", weight=0)
    got = R.scores(docs, lspark.createDataFrame([(t,) for t in target], "text string"), 40)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank", "n_words"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, target, 40)


def test_resample_keeps_the_drawn_rows(documents, lspark):
    rows, target = corpus(4, 120), ["alpha beta2 école"]
    docs, aim = documents(rows, score="own", row=1), lspark.createDataFrame([(t,) for t in target], "text string")
    drawn = [r[0] for r in brute(rows, target, 30) if r[4] is not None]
    got = R.resample(docs, aim, 30)
    assert got.columns == docs.columns
    assert sorted((r.doc_id for r in got.collect()), key=str) == sorted(drawn, key=str)
    assert {r.score for r in got.collect()} == {"own"}


def test_empty_tables(documents, lspark):
    none = lspark.createDataFrame([], "text string")
    assert R.scores(documents([]), none).count() == 0 and R.resample(documents([]), none).count() == 0
    rows = [(k, f"word{k} " * 30) for k in range(30)]
    assert sorted((tuple(r) for r in R.scores(documents(rows), none, 10).collect()), key=str) == brute(rows, [], 10)


def test_many_equal_rows_share_the_ranks(documents, lspark, monkeypatch):
    monkeypatch.setattr(R, "RANK_ROWS", 50)
    rows = [(7, "same words again " * 10)] * 700 + [(k, f"other text {k} " * 10) for k in range(100, 400)]
    got = R.scores(documents(rows), lspark.createDataFrame([("same words",)], "text string"), 90).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 901))
    order = sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])
    assert [(-r.score, r.doc_id) for r in order] == sorted((-r.score, r.doc_id) for r in order)


def test_crc_of_all_lengths():
    rng = np.random.default_rng(2)
    data = rng.integers(0, 256, 200_000).astype(np.uint8)
    length = np.r_[np.arange(0, 600), 1023, 1024, 1025, 1279, 1280, 1281, 5000, 100_000]
    start = rng.integers(0, len(data) - length + 1)
    want = [zlib.crc32(data[s: s + n].tobytes()) for s, n in zip(start, length)]
    assert R.crc32_of(data, start, length).tolist() == want


def test_features_of_pieces_match_the_whole(monkeypatch):
    rng = random.Random(6)
    for limit in (1, 7, 40, 300):
        monkeypatch.setattr(R, "SLICE_BYTES", limit)
        text = "".join(rng.choice(["Ab", "é", " ", " ", ". ", "漢", "x" * 50]) for _ in range(400))
        found = Counter()
        for _, _, f in R.features(pa.array([text])):
            for _, index in f.per_size:
                found.update(f.bucket[index].tolist())
        assert found == Counter(map(bucket, grams(text)[1]))
