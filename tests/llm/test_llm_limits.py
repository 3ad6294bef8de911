"""Parameters away from the registered ones, and texts above the piece size."""

import hashlib
import random

import public_tokenizers
import pytest

from adsieve.llm import bpe, queries
from adsieve.llm import jaccard_join as J
from adsieve.llm.tokens import load


def test_low_thresholds_get_more_trees(documents):
    for threshold in (0.05, 0.2, 0.5, 0.8, 1.0):
        assert J.found_share(threshold, 1, J.trees_needed(threshold)) >= J.TARGET_RECALL - 1e-9
    assert J.trees_needed(0.8) == J.TREES
    with pytest.raises(ValueError):
        J.trees_needed(0.0)
    rows = []  # pairs of six words each, two shared: similarity 0.2
    for k in range(1500):
        own = [f"w{k}x{i}" for i in range(10)]
        rows += [(2 * k, " ".join(own[:6])), (2 * k + 1, " ".join(own[4:]))]
    linked = J.jaccard_links(documents(rows), threshold=0.2, width=1).where("n_links = 1").count()
    assert linked >= 2 * (1500 - 6)


def test_bpe_query_over_its_piece_size(lspark, tmp_path):
    rng = random.Random(6)
    word = "".join(rng.choice("abcdeths") for _ in range(70_000))  # unsplit
    prose = " ".join(rng.choice(["Thé", "words,", "ARE!!", "don't", "café.", "3rd"]) for _ in range(30_000))
    rows = [(1, word), (2, prose), (3, prose[:70_000]), (4, "short text"), (5, None)]
    assert [len(t or "") > bpe.PIECE_CHARS for _, t in rows] == [True, True, True, False, False]
    lspark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    path = public_tokenizers.path("word_bpe_49k.json")
    got = {r.doc_id: r for r in queries.op3_bpe_tree(lspark, str(tmp_path)).collect()}
    for i, text in rows:
        want = load(path).encode(text or "", add_special_tokens=False).ids
        assert got[i].n_tokens == len(want)
        assert got[i].ids_sha256 == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(load(path).decode(want, skip_special_tokens=False).encode()).hexdigest()
