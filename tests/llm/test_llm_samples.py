"""Bounded samples of the models keep their size, at every number of rows."""

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from adsieve.llm import language_id, quality
from adsieve.llm.common import hash_sample, sample_below


@pytest.mark.parametrize("bound", [quality.TRAIN_DOCS, language_id.PROFILE_DOCS])
@pytest.mark.parametrize("rows", [10 ** 5, 10 ** 9, 10 ** 11, 10 ** 13])
def test_threshold_keeps_its_share(bound, rows):
    share = (sample_below(bound, rows) + (1 << 63)) / (1 << 64)
    assert share * rows == pytest.approx(bound, rel=1e-3)


def test_hash_sample(lspark):
    ids = lspark.range(200_000).withColumn("h", F.xxhash64("id"))
    assert 4700 < ids.where(hash_sample(F.col("h"), 5000, 200_000)).count() < 5300
    # a share below 2^-20, the smallest that the former 20-bit hash could draw
    assert 2 < lspark.range(20_000_000).where(hash_sample(F.xxhash64("id"), 8, 1 << 24)).count() < 25
    assert ids.where(hash_sample(F.col("h"), 200_000, 200_000)).count() == 200_000


def test_rows_without_an_id_are_sampled(lspark):
    rows = lspark.range(600).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("word "), F.col("id").cast("string")).alias("text"),
                                    F.lit("xx").alias("lang"))
    assert language_id.learn(rows, docs=60) != {}


def test_rare_language_is_learned_in_full(lspark):
    rows = lspark.range(3000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") < 3, "ŵŷ ŷŵ").otherwise("common words").alias("text"),
        F.when(F.col("id") < 3, "rare").otherwise("xx").alias("lang"))
    profiles = language_id.learn(rows, docs=30)
    assert set(profiles) == {"rare", "xx"}
    assert profiles["rare"] == language_id.learn(rows.where("lang = 'rare'"))["rare"]


def test_rare_label_is_learned(lspark):
    docs = lspark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 4, "$$ ## 99 !! ").otherwise("plain words here ").alias("text"))
    labels = docs.select("doc_id", F.when(F.col("doc_id") < 4, 0).otherwise(1).alias("quality"))
    model = quality.train(docs, labels, n=40)
    assert model.weights is not None and 0.99 < model.share < 1
    score = {r.bad: r.score for r in quality.score(docs, model).groupBy((F.col("row.doc_id") < 4).alias("bad")).agg(F.avg("score").alias("score")).collect()}
    assert score[True] < score[False]


def test_every_passage_is_learned_from(lspark):
    rb = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["word " * 20_000, ""]), pa.array([1, 0], pa.int32())], ["doc_id", "text", "quality"])
    (out,) = quality._bag_task(iter([rb]))
    assert [len(b) // (4 * quality.WIDTH) for b in out.column("bag").to_pylist()] == out.column("n").to_pylist() == [200, 1]


def test_passage_bound_takes_fewer_documents(lspark):
    rng = np.random.default_rng(1)
    found = pd.DataFrame({"quality": [0] * 100 + [1] * 900, "h": rng.integers(-2 ** 62, 2 ** 62, 1000), "n": [7] * 1000})
    last = quality._affordable(found, 700)
    taken = found[found["h"] <= found["quality"].map(last)]
    assert 690 < taken["n"].sum() <= 700 and (taken["quality"] == 0).sum() == 10
    assert set(quality._affordable(found, 0)) == {0, 1}
    docs = lspark.range(400).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 4 == 0, "$$ ## 99 !! ").otherwise("plain words here ").alias("text"))
    labels = docs.select("doc_id", F.least(F.col("doc_id") % 4, F.lit(1)).cast("int").alias("quality"))
    model = quality.train(docs, labels, most=100)
    assert model.weights is not None and model.share == pytest.approx(0.75)
