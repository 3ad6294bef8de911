"""Exact, substring and n-gram dedup against plain Python."""

import random

import brute_llm as B
import pytest
from pyspark.sql import functions as F

from adsieve.llm import exact_dedup as X
from adsieve.llm import jaccard_join as J
from adsieve.llm import substring_dedup as S
from adsieve.llm.components import components


def corpus(seed=3, n=60):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(40)] + ["é", "漢字", "a,b", "x y"]
    passage = [" ".join(rng.choice(vocab) for _ in range(30)) for _ in range(3)]
    rows = []
    for i in range(n):
        w = [rng.choice(vocab) for _ in range(rng.randint(0, 60))]
        if i % 4 == 0:
            w += passage[i % 3].split()
        rows.append((i * 3, rng.choice([" ", "\n", "\t "]).join(w)))
    rows += [(1000, rows[8][1]), (1001, rows[8][1].replace(" ", "  ")), (1002, ""), (1003, None), (1004, " \t\n"),
             (1005, "one two"), (1006, "one two"), (1007, " ".join(rows[20][1].split() + ["tail"])), (1008, "x " * 90), (1009, "x " * 500)]
    return rows


def test_exact(documents):
    rows = corpus()
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in X.decide_copies(documents(rows)).collect()}
    assert got == B.exact(rows)
    assert got[1001][0] == 1001  # more code points win
    assert got[1002][1] >= 3  # empty, null and white space are equal


def test_exact_hot_groups_and_partitioned_filter(documents, monkeypatch):
    rows = [(i, "same text" if i % 3 == 0 else f"text {i}") for i in range(3100)]
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in X.decide_copies(documents(rows)).collect()}
    assert got[3] == (0, 1034, False) and got[1] == (1, 1, True) and sum(v[2] for v in got.values()) == 2067
    monkeypatch.setattr(X, "BROADCAST_BYTES", 0)  # the filter is joined, not broadcast
    assert X.decide_copies(documents(rows)).where("kept").count() == 2067


def test_filter_proves_most_rows_unique(documents):
    docs = documents([(i, f"text {i if i > 9 else 0}") for i in range(2000)])
    prints, bloom, blocks, n = X._build(docs)
    maybe = X._maybe(prints, bloom, blocks).where("__maybe").count()
    assert 10 <= maybe <= 10 + 0.05 * n


def test_drop_copies_keeps_columns(documents):
    rows = [(1, "a b"), (2, "ab"), (3, "c"), (3, "c"), (None, "a  b"), (None, None)]
    docs = documents(rows, kept="own", text_sha256=7, __maybe=1)
    out = X.drop_copies(docs)
    assert out.columns == docs.columns
    got = sorted(((r.doc_id, r.text, r.kept, r.text_sha256) for r in out.collect()), key=str)
    assert got == [(3, "c", "own", 7), (None, "a  b", "own", 7), (None, None, "own", 7)]
    assert X.drop_copies(documents([])).count() == 0 and X.decide_copies(documents([])).count() == 0


@pytest.mark.parametrize("wide", [X.WIDE_FILTER_BYTES, 0])
def test_drop_copies_beyond_the_broadcast_bound(documents, monkeypatch, wide):
    """Whole rows probe the filter of repeated hashes, also one of a single block."""
    rows = corpus() + [(k, f"copy {k % 7}") for k in range(2000, 2100)] + [(k, f"text {k}") for k in range(3000, 4500)] + [(3000, "text 3000")]
    keep = {d: k for d, (_, _, k, _) in B.exact(rows).items()}
    want = sorted({(d, t) for d, t in rows if keep[d]}, key=str)
    monkeypatch.setattr(X, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(X, "WIDE_FILTER_BYTES", wide)
    out = X.drop_copies(documents(rows))
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == want
    groups = X._decide(*X._build(documents(rows)))[1]
    probed = X._maybe(documents(rows).select("doc_id", X._sha()), *X._copied_filter(groups))
    copies = len(rows) - 1500
    assert copies - 60 <= probed.where("__maybe").count() <= copies + 0.05 * len(rows)
    plan = probed.where("not __maybe")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan.split("BroadcastExchange")[0]


def text_tag(lspark):
    """The order of several texts of one id, as the operator documents it."""
    import functools
    return functools.cache(lambda t: lspark.range(1).select(F.xxhash64(F.lit(t or ""))).first()[0])


def cut(docs, width):
    return {(r.doc_id, r.src): (r.n_words, r.n_removed, B.words(r.text)) for r in S.dedup_substrings(docs.withColumn("src", F.coalesce("text", F.lit(""))), width).collect()}


@pytest.mark.parametrize("slice_bytes, seen", [(64, 1 << 19), (64, 3), (1 << 21, 1 << 19)])
def test_substrings(documents, monkeypatch, slice_bytes, seen):
    monkeypatch.setattr(S, "BUCKET_WINDOWS", 50)
    monkeypatch.setattr(S, "PARTITIONS", 5)
    monkeypatch.setattr(S, "SLICE_BYTES", slice_bytes)
    monkeypatch.setattr(S, "SEEN", seen)
    rows = corpus(5)
    assert cut(documents(rows).coalesce(2), 8) == B.substrings(rows, 8)


@pytest.mark.parametrize("broadcast", [1 << 20, 0])
def test_substrings_of_repeated_ids(documents, monkeypatch, lspark, broadcast):
    monkeypatch.setattr(S, "BROADCAST_BYTES", broadcast)
    monkeypatch.setattr(S, "SLICE_BYTES", 64)
    tag, long = text_tag(lspark), " ".join(f"w{k}" for k in range(40))
    tables = [
        [(0, long), (1, long), (1, "a b c")],
        [(0, long), (1, "p q r s t u " + long), (1, "a b c")],
        [(1, long), (1, long + " end"), (1, "lead " + long), (1, long), (1, None), (1, ""), (None, long), (0, "x " * 70)],
        [(k % 3, t) for k, (_, t) in enumerate(corpus(8, 50))],  # an id with a third of all rows
    ]
    for rows in tables:
        docs = documents(rows, __tag="clash", tag=1, __KEY=2)
        got = cut(docs, 8)
        want = B.substrings([(i, t) for i, t in rows if i is not None], 8, tag)
        assert {k: v for k, v in got.items() if k[0] is not None} == want
        assert all(got[None, t] == (40, 0, B.words(t)) for i, t in rows if i is None)
        assert sorted(S.dedup_substrings(docs, 8).groupBy("doc_id").count().collect(), key=str) == sorted(docs.groupBy("doc_id").count().collect(), key=str)


def test_substrings_edges(documents):
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(1, text), (1, text), (None, text), (2, f"lead\n\n{text} tail"), (3, None), (4, "")]
    out = S.dedup_substrings(documents(rows, n_words="old", source="s"))
    assert out.columns == ["doc_id", "source", "text", "n_words", "n_removed"]
    got = sorted(((r.doc_id or 0), r.text, r.n_words, r.n_removed) for r in out.where("text is not null").collect())
    assert got == sorted([(1, text, 30, 0), (1, text, 30, 0), (0, text, 30, 0), (2, "lead tail", 32, 30), (4, "", 0, 0)])
    assert out.where("text is null").first().n_words == 0
    assert S.dedup_substrings(documents([])).count() == 0


@pytest.mark.parametrize("block", [1024, 3])
def test_jaccard(documents, monkeypatch, block):
    monkeypatch.setattr(J, "BLOCK", block)
    rng = random.Random(block)
    rows = corpus(9, 40)
    base = [f"t{rng.randint(0, 400)}" for _ in range(120)]
    for k in range(25):  # near copies, all different
        w = list(base)
        w[rng.randint(0, 119)] = f"edit{k}"
        rows.append((2000 + k, " ".join(w)))
    rows += [(3000, " ".join(base[:100])), (3001, " ".join(base[:60]))]
    got = {r.doc_id: (r.n_links, r.component_id, r.kept) for r in J.jaccard_links(documents(rows)).collect()}
    assert got == B.jaccard(rows)


def test_jaccard_edges(documents):
    rows = [(5, "a b c"), (5, "a b c"), (None, "a b c"), (7, "a b c"), (8, None), (9, "")]
    got = sorted(((r.doc_id or 0), r.n_links, r.component_id or 0, r.kept) for r in J.jaccard_links(documents(rows)).collect())
    assert got == [(0, 0, 0, True), (5, 2, 5, True), (5, 2, 5, True), (7, 2, 5, False), (8, 0, 8, True), (9, 0, 9, True)]
    assert J.jaccard_links(documents([])).count() == 0


def test_prefixes_shorten_until_the_recall_is_reached(documents, monkeypatch):
    met, level = [], J.meetings
    monkeypatch.setattr(J, "meetings", lambda tied, groups: met.append(groups.count()) or level(tied, groups))
    # ends cut off: similarity 0.96; nothing lies near the threshold but what might be unseen
    high = [(2 * k + j, " ".join(f"d{k}w{i}" for i in range(200 - 4 * j))) for k in range(300) for j in range(2)]
    assert J.jaccard_links(documents(high)).where("n_links = 1").count() == 600
    assert met == [600]  # the whole label sufficed
    met.clear()
    rows = [(2 * k + j, " ".join(f"d{k}w{i}" for i in range(60 - 11 * j))) for k in range(300) for j in range(2)]  # similarity 45/56
    rows += [(1000 + i, t) for i, t in high[:200]]
    got = {r.doc_id: (r.n_links, r.component_id, r.kept) for r in J.jaccard_links(documents(rows)).collect()}
    assert got == {i: (1, i - i % 2, i % 2 == 0) for i, _ in rows}
    assert len(met) == 2 and met[0] > 700 and met[1] < 50  # shortened; only changed groups were met again
    assert J.safe_depth(0.8, J.TREES) == 5 and J.safe_depth(0.05, J.trees_needed(0.05)) == 1
    assert J.measured_recall(10 ** 6, 10 ** 6 * 1.00001, 0.8, 6, 24) < 1
    assert J.found_share(0.8, 5, J.TREES) > J.TARGET_RECALL


def test_a_chain_is_verified_by_shared_prefixes(documents, monkeypatch):
    """Texts that slide by two words: a component of 250 in which only near
    neighbours share prefixes. Nodes are met, not the square of the chain."""
    words = [f"w{k}" for k in range(600)]
    rows = [(k, " ".join(words[2 * k: 2 * k + 60])) for k in range(250)]
    kinds = []
    level = J.meetings
    monkeypatch.setattr(J, "meetings", lambda *a: kinds.append(level(*a)) or kinds[-1])
    monkeypatch.setattr(J, "DEPTH", 5)
    monkeypatch.setattr(J, "BLOCK", 5)
    got = {r.doc_id: (r.n_links, r.component_id, r.kept) for r in J.jaccard_links(documents(rows)).collect()}
    assert got == B.jaccard(rows)
    met = kinds[-1].select(F.explode("meets").alias("m")).select("m.*")
    assert met.where("tree >= 0").count() > 250 and met.where("tree < 0").count() < 40
    largest = met.groupBy("grp").count().agg(F.max("count")).first()[0]
    assert largest < 60


def test_components(lspark):
    rng = random.Random(1)
    edges = [(k, k + 1) for k in range(100, 130)] + [(500, k) for k in range(501, 540)] + [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(40)]
    near = {}
    for u, v in edges:
        near.setdefault(u, []).append(v)
        near.setdefault(v, []).append(u)
    want = {k: c for k, c in B.reach(near, near).items() if any(x != k for x in near[k])}
    got = {r.id: r.component for r in components(lspark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == want


def test_components_move_a_link_once(lspark, monkeypatch):
    from adsieve.llm import components as C

    moved = []
    save = C._save
    monkeypatch.setattr(C, "_save", lambda df, rows, name: moved.append(df._jdf.queryExecution().optimizedPlan().toString()) or save(df, rows, name))
    # a hub, a chain and a group with several links an id; loops and nulls link nothing
    edges = [(i, 0) for i in range(1, 60)] + [(i, i + 1) for i in range(100, 130)] + [(200 + i, 200 + j) for i in range(12) for j in range(i)]
    edges += [(500, 500), (None, 3), (4, None)]
    got = {r.id: r.component for r in components(lspark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(60)} | {i: 100 for i in range(100, 131)} | {i: 200 for i in range(200, 212)}
    # no row a link for the id that moves: two rows a link and direction made most of the work
    assert moved and not any("Generate" in plan for plan in moved)
