"""Language identification by rank-order n-gram profiles.

A profile is the list of the ``TOP`` most frequent character n-grams (one to
three characters of lower-case words, with a space on either side of a word).
A document's own most frequent n-grams are compared to each language's by the
out-of-place distance: the sum of rank differences, ``TOP`` for an n-gram the
profile lacks. The nearest language wins.

Profiles are learned from at most about ``PROFILE_DOCS`` labelled documents of
each language (chosen by a hash of id and text), so a rare language is learned
in full beside a common one. Their n-grams are counted per task first and
then summed in Spark, so a language holding most rows is no hot key.

Defined results: ``und`` with score 0 where the text is null or has no letter
(Unicode category L; marks belong to the word they stand in, but a text of
marks alone has no letter), or no language was learned. Equal frequencies rank by code point, equal
distances by language name. The score is ``d2 / (d1 + d2)`` of the best two
distances (the greatest possible distance stands in for a missing second).
Rows of equal id are judged each for itself; other columns are ignored.
"""

from __future__ import annotations

import functools
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adsieve.llm.common import sample_below

TOP = 300
PROFILE_DOCS = 20_000
UNKNOWN = "und"
_SPACE = 32


@functools.lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """Per code point: 2 a letter, 1 a mark (part of a word, but no letter), 0 else."""
    kind = {"L": 2, "M": 1}
    return np.fromiter((kind.get(unicodedata.category(chr(c))[0], 0) for c in range(sys.maxunicode + 1)), np.uint8, sys.maxunicode + 1)


def ngrams(text: str) -> np.ndarray:
    """Codes of all n-grams of a text, 21 bits a character; none where the
    text has no letter."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = _kinds()[c]
    if not (kind == 2).any():
        return np.empty(0, np.int64)
    letter = kind > 0
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # one space after each word
    c = np.where(letter, c, _SPACE)[keep].astype(np.int64)
    c = np.r_[_SPACE, c] if c[-1] == _SPACE else np.r_[_SPACE, c, _SPACE]
    one = c[c != _SPACE]
    two = c[:-1] << 21 | c[1:]
    inner = c[1:-1] != _SPACE  # no n-gram spans two words
    three = ((c[:-2] << 42) | (c[1:-1] << 21) | c[2:])[inner]
    return np.concatenate([one, two, three])


def ranking(codes: np.ndarray, counts: np.ndarray, top: int = TOP) -> np.ndarray:
    """The most frequent codes, first rank first (``codes`` ascending)."""
    if len(codes) > 2 * top:  # drop what cannot reach the top before sorting
        least = np.partition(counts, len(counts) - top)[len(counts) - top]
        codes, counts = codes[counts >= least], counts[counts >= least]
    return codes[np.argsort(-counts, kind="stable")[:top]]


def distance(ranked: np.ndarray, codes: np.ndarray, ranks: np.ndarray, top: int = TOP) -> int:
    """Out-of-place distance to a profile (``codes`` ascending with ``ranks``)."""
    at = np.minimum(np.searchsorted(codes, ranked), len(codes) - 1)
    return int(np.where(codes[at] == ranked, np.abs(ranks[at] - np.arange(len(ranked))), top).sum())


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rb in batches:
        texts = pd.Series(rb.column("text").to_pylist()).groupby(np.array(rb.column("lang").to_pylist(), dtype=object))
        for lang, group in texts:
            codes, counts = np.unique(np.concatenate([ngrams(t) for t in group]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes), pa.array(counts)],
                                             ["lang", "gram", "n"])


def learn(labelled: DataFrame, docs: int = PROFILE_DOCS, top: int = TOP) -> dict[str, list[int]]:
    """Profiles by language from ``(doc_id, text, lang)``: n-grams by rank."""
    rows = labelled.where("text is not null and lang is not null")
    # one row a language, like the profiles
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    large = [(lang, sample_below(docs, n)) for lang, n in sizes.items() if n > docs]
    if large:
        below = labelled.sparkSession.createDataFrame(large, "lang string, below long")
        # the text is hashed too: rows of one id, or without any, are drawn each for itself
        rows = rows.join(F.broadcast(below), "lang", "left").where(F.col("below").isNull() | (F.xxhash64("doc_id", "text") < F.col("below")))
    counts = rows.select("lang", "text").mapInArrow(_count_task, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    best = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    profiles: dict[str, list[int]] = {}
    for r in best.orderBy("lang", "rank").collect():  # ``top`` rows a language
        profiles.setdefault(r["lang"], []).append(r["gram"])
    return profiles


def _judge(profiles: dict[str, list[int]], top: int):
    names = sorted(profiles)
    known = []
    for name in names:
        codes = np.array(profiles[name], dtype=np.int64)
        order = np.argsort(codes)
        known.append((codes[order], order))

    def one(text: str | None) -> tuple[str, float]:
        codes = ngrams(text) if text else np.empty(0, np.int64)
        if not len(codes) or not known:
            return UNKNOWN, 0.0
        ranked = ranking(*np.unique(codes, return_counts=True), top)
        d = [distance(ranked, c, r, top) for c, r in known]
        best = int(np.argmin(d))
        second = min([*d[:best], *d[best + 1:]], default=top * len(ranked))
        return names[best], second / (d[best] + second) if d[best] + second else 1.0

    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([one(t) for t in texts], columns=["lang_pred", "score"])
    return run


def identify(text: Column | str, profiles: dict[str, list[int]], top: int = TOP) -> Column:
    """Struct ``(lang_pred, score)`` of a text column."""
    return F.pandas_udf(_judge(profiles, top), "lang_pred string, score double")(text)


def classify(docs: DataFrame, profiles: dict[str, list[int]], top: int = TOP) -> DataFrame:
    """``doc_id, lang_pred, score`` of every document."""
    return docs.select("doc_id", identify("text", profiles, top).alias("__id")).select("doc_id", "__id.*")
