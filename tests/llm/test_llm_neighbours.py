"""k-means tree search against brute force."""

import math

import numpy as np
import pytest

from adsieve.llm import kmeans_tree as T

SCHEMA = "vec_id long, embedding array<double>"


def fine(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute(rows, queries, k):
    known = {(i, tuple(x + 0.0 for x in v)) for i, v in rows if i is not None and v is not None and fine(v)}
    out = []
    for i, v in {(i, tuple(x + 0.0 for x in v)) for i, v in queries if i is not None and v is not None and fine(v)}:
        near = sorted((math.dist(v, w), j) for j, w in known if len(w) == len(v) and (j, w) != (i, v))
        out += [(i, rank + 1, j, d) for rank, (d, j) in enumerate(near[:k])]
    return sorted(out)


def same(got, want):
    got = sorted(tuple(r) for r in got)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], rtol=1e-12, atol=0)


def points(seed, n, d=6):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(5, d))
    return [(k, (centre[k % 5] + rng.normal(size=d) * 0.3).tolist()) for k in range(n)]


@pytest.mark.parametrize("members, visitors", [(1 << 14, 1 << 13), (7, 3)])
def test_all_leaves_equal_brute_force(lspark, monkeypatch, members, visitors):
    for name, value in (("LEAF", 16), ("MEMBERS", members), ("VISITORS", visitors), ("SAMPLE", 150), ("BRANCHES", 4)):
        monkeypatch.setattr(T, name, value)
    rows = points(1, 300)
    rows += [(1000 + k, rows[3][1]) for k in range(40)] + [(2000 + k, [1.0, float(k)]) for k in range(4)]  # copies; another length
    rows += [(7, rows[3][1]), (9, rows[9][1]), (9, rows[9][1]), (10, (np.array(rows[10][1]) * 1.5).tolist())]  # repeated ids
    rows += [(3000, None), (3010, []), (3020, [0.0] * 6), (3030, [float("nan")] + [1.0] * 5), (3040, [None] + [1.0] * 5), (None, rows[0][1]), (3050, [float("inf")] * 6)]
    df = lspark.createDataFrame(rows, SCHEMA).withColumnRenamed("embedding", "e").selectExpr("vec_id", "e embedding", "1 q", "2 leaf", "'x' score")
    queries = df.where("vec_id % 10 = 0 or vec_id in (7, 9)")
    asked = [r for r in rows if r[0] is not None and (r[0] % 10 == 0 or r[0] in (7, 9))]
    got = T.nearest(df, queries, 5, recall=1.0)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    same(got.collect(), brute(rows, asked, 5))


def test_a_third_of_the_rows_equal(lspark, monkeypatch):
    monkeypatch.setattr(T, "LEAF", 16)
    rows = points(2, 400) + [(1000 + k, [1.0] * 6) for k in range(200)]
    index = T.build_index(lspark.createDataFrame(rows, SCHEMA), 10)
    assert index.members.selectExpr("max(size(ids))").first()[0] == 11  # no more can be an answer
    same(T.search(index, lspark.createDataFrame(rows[300:450], SCHEMA), 1.0).collect(), brute(rows, rows[300:450], 10))


def test_extreme_values(lspark):
    rng = np.random.default_rng(5)
    for scale in (1e300, 1e-300, 1e160):
        rows = [(k, (rng.normal(size=4) * scale).tolist()) for k in range(30)]
        same(T.nearest(lspark.createDataFrame(rows, SCHEMA), lspark.createDataFrame(rows[:9], SCHEMA), 4).collect(), brute(rows, rows[:9], 4))


def test_empty(lspark):
    none, some = lspark.createDataFrame([], SCHEMA), lspark.createDataFrame([(100, [1.0, 2.0])], SCHEMA)
    assert T.nearest(none, none).count() == 0 and T.nearest(some, none).count() == 0
    assert T.nearest(some, some).count() == 0 and T.nearest(none, some).count() == 0
    two = some.unionByName(lspark.createDataFrame([(1, [1.0, 2.5])], SCHEMA))
    assert [tuple(r) for r in T.nearest(two, some).collect()] == [(100, 1, 1, 0.5)]


def test_best_bin_first():
    x = np.random.default_rng(4).normal(size=(500, 3))
    tree = T.build(x, 20)
    assert np.bincount(tree.assign(x), minlength=tree.leaves).sum() == 500 and tree.leaves > 20
    for q, order in zip(x[:20], tree.visits(x[:20], tree.leaves)):
        assert sorted(order) == list(range(tree.leaves))
    first = tree.visits(x[:50], 1)
    assert np.mean([f[0] == a for f, a in zip(first, tree.assign(x[:50]))]) > 0.8
    assert [v[:3] for v in tree.visits(x[:50], 7)] == tree.visits(x[:50], 3)


def test_registered_query_reaches_the_recall(lspark):
    import __spark_entry__ as E
    base = "/root/testdata/sf0.1"
    got = E.queries()["op12_nearest"](lspark, base).collect()
    rows = [(r.vec_id, r.embedding) for r in lspark.read.parquet(f"{base}/embeddings.parquet").select("vec_id", "embedding").collect()]
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], dtype=float)
    hits, asked = 0, [i for i in ids.tolist() if i % 100 == 0]
    mine = {}
    for r in got:
        mine.setdefault(r.query_id, []).append(r)
    assert sorted(mine) == sorted(asked)
    for i in asked:
        d = np.sqrt(((x - x[ids == i]) ** 2).sum(axis=1))
        order = np.lexsort((ids, d))
        hits += len({r.vec_id for r in mine[i]} & set(ids[order[ids[order] != i][:10]].tolist()))
        near = sorted(mine[i], key=lambda r: r["rank"])
        assert [r["rank"] for r in near] == list(range(1, 11))
        assert [(r.score, r.vec_id) for r in near] == sorted((r.score, r.vec_id) for r in near)
        assert all(abs(d[ids == r.vec_id][0] - r.score) < 1e-12 for r in near)
    assert hits >= 0.93 * 10 * len(asked)
