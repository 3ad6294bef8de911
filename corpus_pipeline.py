"""Corpus pipeline: five stages over ``documents``, each one operator.

``STAGES`` lists (name, function); each function takes ``(spark, docs,
sf_dir)`` and returns a DataFrame that is written as Parquet and read again as
the next stage's ``docs``. ``run`` applies them to the ``documents`` table.
All stages but the last return the columns of ``docs``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adsieve.llm import quality
from adsieve.llm.common import broadcast_if_small, crc_mod, prepare, stored, table
from adsieve.llm.exact_dedup import drop_copies
from adsieve.llm.jaccard_join import jaccard_links
from adsieve.llm.packing import pack
from adsieve.llm.substring_dedup import dedup_substrings


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It learns from ``labels``,
    but for the held-out third of the ids."""
    prepare(spark)
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality").where(crc_mod("doc_id", 3) != 1)
    return quality.score(docs, quality.train(docs, labels)).where("score >= 0.5").select("row.*")


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of equal texts stays."""
    prepare(spark)
    return drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest id) of every group of near-duplicates stays."""
    prepare(spark)
    gone = stored(jaccard_links(docs).where("not kept").select("doc_id").distinct(), "gone")
    return docs.join(broadcast_if_small(gone, gone.count(), 24), "doc_id", "left_anti").select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that occurred before are cut from the texts."""
    prepare(spark)
    cut = dedup_substrings(docs)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return cut.select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining texts, placed in sequences of 1,024 tokens."""
    prepare(spark)
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_mil", good_quality),
    ("exact_dedup", exact_copies),
    ("jaccard_join", near_copies),
    ("substring_dedup", repeated_passages),
    ("packing", packed),
]

# learned scores, minimum hashing and column generation are not expressible in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{name}")
    return docs
