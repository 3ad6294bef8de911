"""Tokenizing, packing, language profiles, the classifier and the pipeline."""

import hashlib
import random
import zlib

import brute_llm as B
import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from adsieve.llm import bpe, language_id, packing, quality
from adsieve.llm.common import crc_mod
from adsieve.llm.textcodes import Words, planes, shingles, slices, unplanes
from adsieve.llm.tokens import ByteEncoder, WordEncoder, encoder, load

WORD, BYTE = P.path("word_bpe_49k.json"), P.path("byte_bpe_50k.json")
ODD = [*"abcdeths'rel!?.,0123 \n\t  é́<|>İıßÅΣς", "漢字", "ñ", "한", "ᅡ", "ᄀ", "​", "\xa0", "\x1c", "\x85",
       "<|endoftext|>", "<|startoftext|>", "'ll", "'s", "it's", "  "]


def odd(rng, n):
    return "".join(rng.choice(ODD) for _ in range(n))


def ids(path, text):
    return load(path).encode(text, add_special_tokens=False).ids


def test_encoders_match_the_library():
    rng = random.Random(1)
    for k in range(800):
        text = odd(rng, rng.randint(0, 120)) if k % 2 else " ".join(rng.choice(["Thé", "words,", "ARE!!", "don't", "x***", "café.", "3rd"]) for _ in range(30))
        for kind, path in ((WordEncoder, WORD), (ByteEncoder, BYTE)):
            assert np.frombuffer(encoder(kind, path).ids(text), "<u4").tolist() == ids(path, text), text


@pytest.mark.parametrize("kind", range(5))
def test_tree_concatenation(kind):
    rng = random.Random(kind)
    enc = encoder(WordEncoder, WORD)
    for _ in range(25):
        text = [lambda: odd(rng, rng.randint(100, 1500)),
                lambda: "".join(rng.choice("abcdeths") for _ in range(rng.randint(100, 2500))),  # unsplit
                lambda: rng.choice(["a", "ha", "!'s", "the", "0"]) * rng.randint(100, 900),
                lambda: "".join(rng.choice(["'s", "!!", "'re", "a", "é", "é", "́"]) for _ in range(600)),
                lambda: " ".join(odd(rng, rng.randint(1, 9)) for _ in range(200))][kind]()
        cuts = bpe.halves(len(text), rng.choice([40, 150, 333]))
        pieces = [(i, s + a, e + a) for a, b in zip(cuts, cuts[1:]) for i, s, e in [enc.with_edges(text[a:b], 20)]]
        assert bpe.concatenate(text, cuts, pieces, enc.with_offsets)[0].tolist() == ids(WORD, text)


def test_encode_decode(documents):
    rng = random.Random(2)
    rows = [(1, None), (2, ""), (3, "short text"), (4, "word " * 300), (5, "x" * 700), (5, "x" * 700), (None, odd(rng, 900)), (7, odd(rng, 2000)), (8, "word " * 300)]
    docs = documents(rows, ids="clash", c0=1, at=2)
    out = bpe.decode(bpe.encode(docs, WORD, piece=100), WORD)
    assert out.columns == ["doc_id", "text", "c0", "at", "ids", "decoded"]
    got = out.collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in got) == sorted((i or 0, t or "") for i, t in rows)
    for r in got:
        want = ids(WORD, r.text or "")
        assert r.ids == want and r.decoded == load(WORD).decode(want, skip_special_tokens=False)
    assert bpe.encode(documents([]), WORD).count() == 0


def check_packing(rows, out, capacity):
    want = {i: np.array(ids(BYTE, t or "") + [0], "<u4") for i, t in rows}
    pieces, seqs = {}, {}
    for r in out:
        pieces.setdefault(r.doc_id, []).append(r)
        seqs.setdefault(r.sequence_id, []).append(r)
        assert r.ids_crc32 == zlib.crc32(want[r.doc_id][r.start: r.start + r.length].tobytes()) and r.doc_tokens == len(want[r.doc_id])
    copies = {i: sum(x == i for x, _ in rows) for i, _ in rows}
    for i, w in want.items():
        covered = sorted(k for r in pieces[i] for k in range(r.start, r.start + r.length))
        assert covered == sorted(list(range(len(w))) * copies[i])
    pad = 0
    for s in seqs.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
        pad += 0 if at & (at - 1) == 0 else capacity - at
    return pad


@pytest.mark.parametrize("n", [1, 7, 400])
def test_packing(documents, n):
    rng = random.Random(n)
    rows = [(k, " ".join(rng.choice(["some", "words", "Ünï", "x"]) for _ in range(rng.randint(0, 60)))) for k in range(n)]
    rows += [(9000, None), (9001, ""), (9002, "long " * 900), (9003, "twin " * 50), (9003, "twin " * 50), (None, "no id at all")]
    out = packing.pack(documents(rows, length=1, units="u"), BYTE, capacity=128).collect()
    total = sum(r.length for r in out)
    assert check_packing(rows, out, 128) <= 0.12 * total + 128
    assert packing.pack(documents([]), BYTE).count() == 0


def test_repeated_pieces_rank_over_many_tasks(lspark, monkeypatch):
    monkeypatch.setattr(packing, "RANK_ROWS", 100)
    rows = [(1, 0, 5, 9, 5, 1, k) for k in range(2000)] + [(k, 0, 5, k, 5, 1, 5000 + k) for k in range(2, 500)] + [(7, 0, 20, 1, 20, 3, 9000)]
    pieces = lspark.createDataFrame(rows, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, units long, row long")
    out = packing._ranked(pieces, len(rows))
    assert out.columns == ["units", *[c for c in pieces.columns if c not in ("units", "row")], "rank"]
    got = out.collect()
    assert sorted(r["rank"] for r in got if r.units == 1) == list(range(2498)) and [r["rank"] for r in got if r.units == 3] == [0]
    # no part holds more than a few hundred of the 2,000 equal rows
    parts = packing._parts(pieces, len(rows)).groupBy("units", "part").count()
    assert parts.agg(F.max("count")).first()[0] < 700


def test_column_generation():
    rng = np.random.default_rng(5)
    lengths, counts = np.unique(np.clip(rng.gamma(2, 20, 20_000).astype(int), 1, 128), return_counts=True)
    slots, sequences = packing.plan(dict(zip(lengths.tolist(), counts.tolist())))
    used = sum((z - a) * n for n, a, z, *_ in slots)
    assert used >= 0.99 * sequences * 128 and used >= 0.98 * (lengths * counts).sum()
    value, pattern = packing.price(np.array([3, 5]), np.array([4.0, 7.0]), 11)
    assert value == 15.0 and pattern.tolist() == [2, 1]


def test_rankings_match_strings():
    rng = random.Random(4)
    for _ in range(50):
        text = odd(rng, 200).replace("<|endoftext|>", "Ende")
        codes, counts = np.unique(language_id.ngrams(text), return_counts=True)
        name = {}
        for c, n in zip(codes.tolist(), counts.tolist()):
            s = "".join(chr(x) for x in (c >> 42, c >> 21 & 0x1FFFFF, c & 0x1FFFFF) if x)
            name[s] = n
        assert name == dict(B.ranks(text, 10))
        top = language_id.ranking(codes, counts, 10)
        assert top.tolist() == [c for _, c in sorted(zip((-counts).tolist(), codes.tolist()))[:10]]


def test_language_id_by_strings(lspark):
    """The registered query, row for row, against the plain version."""
    import zlib

    import __spark_entry__ as E
    base = "/root/testdata/sf0.001"
    docs = lspark.read.parquet(f"{base}/documents.parquet").select("doc_id", "text", "lang").collect()
    fold = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 4 for r in docs}
    profiles = B.languages([(r.text, r.lang) for r in docs if fold[r.doc_id] != 2], language_id.TOP)
    got = {r.doc_id: r for r in E.queries()["op10_language_id"](lspark, base).collect()}
    for r in docs:
        lang, score = B.language(r.text, profiles, language_id.TOP)
        assert (got[r.doc_id].lang_pred, got[r.doc_id].held_out) == (lang, fold[r.doc_id] == 2)
        assert got[r.doc_id].score == pytest.approx(score, abs=1e-12)
    odd_texts = [None, "", "12 34", "\u2764\ufe0f", "\u0301", "\u0301\u0302 9", "\u24b6", "a\u0301", "\u2764\ufe0f the house", "\u0669"]
    edges = lspark.createDataFrame(list(enumerate(odd_texts)), "doc_id long, text string")
    for r in language_id.classify(edges, language_id.learn(lspark.createDataFrame(docs).where(crc_mod("doc_id", 4) != 2))).collect():
        lang, score = B.language(odd_texts[r.doc_id], profiles, language_id.TOP)
        assert r.lang_pred == lang and r.score == pytest.approx(score, abs=1e-12)
        assert (lang == "und") == (r.doc_id not in (7, 8))


def test_language_id(lspark):
    docs = lspark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    profiles = language_id.learn(docs.where(crc_mod("doc_id", 4) != 2))
    got = language_id.classify(docs, profiles).join(docs.select("doc_id", "lang"), "doc_id").where(crc_mod("doc_id", 4) == 2)
    right, n = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count(F.lit(1))).first()
    assert right > 0.97 and n > 200
    edges = lspark.createDataFrame([(1, None), (2, ""), (3, "123 !"), (4, "的" * 9), (None, "the words of the")], "doc_id long, text string")
    edge = {r.doc_id: r for r in language_id.classify(edges, profiles).collect()}
    assert [edge[k].lang_pred for k in (1, 2, 3)] == ["und"] * 3 and edge[4].lang_pred in profiles and edge[None].lang_pred == "en"
    assert all(0 <= r.score <= 1 for r in edge.values())
    assert language_id.learn(docs.limit(0)) == {}
    assert {r.lang_pred for r in language_id.classify(edges, {}).collect()} == {"und"}


def test_quality(lspark):
    base = "/root/testdata/sf0.01"
    docs, labels = lspark.read.parquet(f"{base}/documents.parquet"), lspark.read.parquet(f"{base}/labels.parquet").select("doc_id", "quality")
    model = quality.train(docs, labels.where(crc_mod("doc_id", 3) != 1))
    got = quality.score(docs, model).select("row.doc_id", "score").join(labels, "doc_id").where(crc_mod("doc_id", 3) == 1).toPandas()
    assert ((got.score >= 0.5) == (got.quality == 1)).mean() > 0.95
    edges = lspark.createDataFrame([(1, None, 1), (2, "", 2), (None, "x " * 5000, 3), (4, "y", 4)], "doc_id long, text string, score int")
    out = quality.score(edges, model)
    assert out.columns == ["row", "score"] and out.where("score between 0 and 1").count() == 4
    assert quality.train(docs, labels.limit(0)).share == 1.0
    one = quality.train(docs, labels.where("quality = 0"))
    assert {r.score for r in quality.score(edges, one).collect()} == {0.0}
    assert quality.score(edges.limit(0), model).count() == 0


def test_attention_gradients():
    rng = np.random.default_rng(3)
    bags = [rng.normal(size=(rng.integers(1, 5), quality.WIDTH)) + (k % 2) * 0.7 for k in range(60)]
    labels = np.array([k % 2 for k in range(60)], dtype=float)
    model = quality.fit(bags, labels)
    doc = np.repeat(np.arange(60), [len(b) for b in bags])
    assert ((model.score(doc, np.concatenate(bags), 60) >= 0.5) == labels).mean() == 1.0


    # the gradient against differences of the loss
    weights = {k: v + rng.normal(0, 0.3, v.shape) for k, v in model.weights.items()}
    few, first = 9, np.r_[0, np.cumsum([len(b) for b in bags[:8]])]
    x, of, worth = np.concatenate(bags[:few]), doc[: sum(map(len, bags[:few]))], rng.uniform(0.5, 2, few)

    def loss(w):
        p = quality._forward(w, np.tanh(x @ w["E"] + w["e"]), of, first)[0]
        y = labels[:few]
        return -(worth * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / few

    grad = quality._gradient(weights, x, of, first, labels[:few], worth)
    for name, v in weights.items():
        for at in rng.integers(0, v.size, 12):
            moved = [{**weights, name: v.copy()} for _ in range(2)]
            for m, step in zip(moved, (1e-5, -1e-5)):
                m[name].ravel()[at] += step
            assert abs((loss(moved[0]) - loss(moved[1])) / 2e-5 - grad[name].ravel()[at]) < 1e-6, name


def test_quality_query_against_plain_python(lspark, monkeypatch):
    """The registered query's rows, and odd texts that stand side by side."""
    from adsieve.llm.queries import QUERIES

    kept = []
    real = quality.train
    monkeypatch.setattr("adsieve.llm.queries.quality.train", lambda *a, **k: kept.append(real(*a, **k)) or kept[0])
    base = "/root/testdata/sf0.001"
    got = QUERIES["op6_quality_mil"](lspark, base).collect()
    texts = {r.doc_id: r.text for r in lspark.read.parquet(f"{base}/documents.parquet").collect()}
    assert len(got) == len(texts)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == (r.score >= 0.5)
        assert abs(r.score - B.attention_score(kept[0], texts[r.doc_id])) < 1e-9, r.doc_id
    rows = [(1, "a B c."), (2, " \n\t lead"), (3, "   "), (4, "\t\tZ9! " * 130 + " "), (5, None), (6, " "), (7, "é 漢 x x x"), (8, ""), (9, "\r\nend ")]
    out = quality.score(lspark.createDataFrame(rows, "doc_id long, text string").coalesce(1), kept[0]).collect()
    for r in out:
        assert abs(r.score - B.attention_score(kept[0], r.row.text)) < 1e-9, r


def test_codes():
    texts = ["a b c d e f", "", "  lead", None, "a b c d e f g", "x", "é x y\x0bz", "a b c d e f"]
    for i, j, buf, base in slices(pa.array(texts), 7):
        w = Words(buf, base)
        for k in range(i, j):
            a, b = w.first[k - i], w.first[k - i + 1]
            assert [bytes(buf[s:e]).decode() for s, e in zip(w.start[a:b], w.end[a:b])] == B.words(texts[k])
    whole = next(iter(slices(pa.array(texts), 1 << 20)))
    doc, code = shingles(Words(whole[2], whole[3]), 5)
    sets = [set(code[doc == k].tolist()) for k in range(len(texts))]
    assert sets[0] == sets[7] and sets[0] < sets[4] and len(sets[5]) == 1 and not sets[1] and len(sets[6]) == 1
    a = np.array([1, -5, 2 ** 40], np.int64)
    assert unplanes(planes(a), np.int64).tolist() == a.tolist()


def test_pipeline_stages(lspark, tmp_path):
    import corpus_pipeline as C
    base = "/root/testdata/sf0.001"
    docs = lspark.read.parquet(f"{base}/documents.parquet")
    labels = lspark.read.parquet(f"{base}/labels.parquet").select("doc_id", "quality")
    before = docs
    for k, (name, stage) in enumerate(C.STAGES):
        after = stage(lspark, before, base)
        path = str(tmp_path / name)
        after.write.parquet(path)
        after = lspark.read.parquet(path)
        rows, then = {r.doc_id: r.text for r in before.collect()}, after.collect()
        if k < 4:
            assert after.columns == docs.columns and after.dtypes == docs.dtypes
        if name == "quality_mil":
            good = {r.doc_id for r in labels.where("quality = 1").collect()}
            assert len(good - {r.doc_id for r in then}) <= 0.03 * len(good)
        elif name == "exact_dedup":
            assert {r.doc_id for r in then} == {i for i, d in B.exact(list(rows.items())).items() if d[2]}
        elif name == "jaccard_join":
            assert {r.doc_id for r in then} == {i for i, d in B.jaccard(list(rows.items())).items() if d[2]}
        elif name == "substring_dedup":
            want = B.substrings(list(rows.items()), 20)
            assert {r.doc_id: B.words(r.text) for r in then} == {i: d[2] for (i, _), d in want.items()}
            assert all(r.n_chars == len(r.text) for r in then)
        else:
            check_packing(list(rows.items()), then, 1024)
        before = after


def test_queries_have_digests(lspark):
    import __spark_entry__ as E
    docs = lspark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    got = {r.doc_id: r for r in E.queries()["op3_bpe_tree"](lspark, "/root/testdata/sf0.001").collect()}
    for d in docs[:40]:
        want = ids(WORD, d.text)
        assert got[d.doc_id].n_tokens == len(want)
        assert got[d.doc_id].ids_sha256 == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()
        assert got[d.doc_id].decoded_sha256 == hashlib.sha256(load(WORD).decode(want, skip_special_tokens=False).encode()).hexdigest()
