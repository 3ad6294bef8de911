"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE_WORDS`` words. Every passage is
encoded as a vector of byte-class shares, word shapes and repetition measures,
standardised and embedded by a learned layer. Gated attention
``softmax(w . (tanh(V e) * sigmoid(U e)))`` weights the passages, and the
weighted sum is scored. All weights are learned from the documents' labels
alone; passages have none.

The network is fitted on at most about ``TRAIN_DOCS`` documents of each label
(chosen by a hash of the id), every passage of each. Where they hold over
``PASSAGES`` passages, fewer documents are taken, the same share of every label
(one document of each at least, however long). A document weighs as many as it stands for, so a rare label is kept
and its share among the labelled documents still counts. Scoring reads every passage of every document.

Defined results: a null or empty text is one passage of zeros and gets a
score like any other. Without any labelled document, or with one class only,
every score is the share of label 1 (1 if there is none). Labels that repeat
for an id count once, the lowest. Rows of equal id are scored each for itself;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adsieve.llm.common import hash_sample, stored
from adsieve.llm.textcodes import Words, mix, slices

PASSAGE_WORDS = 100
TRAIN_DOCS = 8_000
PASSAGES = 512_000
SLICE_BYTES = 1 << 20
EMBED, GATE = 24, 12
EPOCHS, BATCH, RATE, DECAY = 30, 64, 0.01, 1e-4

# one class per ASCII mark, and classes for letters, digits, white space, other bytes
_CLASSES = 40


def _byte_class() -> np.ndarray:
    out = np.full(256, 39, dtype=np.int32)
    out[48:58] = 0
    out[65:91] = 1
    out[97:123] = 2
    out[[32, 9, 11, 12]] = 3
    out[[10, 13]] = 4
    marks = [i for i in range(33, 127) if not chr(i).isalnum()]
    out[marks] = 5 + np.arange(len(marks))
    return out


_CLASS = _byte_class()
WIDTH = _CLASSES + 8


def passages(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(document index, features) of every passage; a document without words
    has one passage of zeros."""
    per_doc = np.maximum(1, -(-words.counts // PASSAGE_WORDS))
    doc = np.repeat(np.arange(len(per_doc)), per_doc)
    first_passage = np.r_[0, np.cumsum(per_doc)]
    out = np.zeros((len(doc), WIDTH))
    if not len(words.code):
        return doc, out
    n = len(doc)
    order = np.arange(len(words.code)) - words.first[words.doc]
    at = first_passage[words.doc] + order // PASSAGE_WORDS
    count = np.bincount(at, minlength=n)
    # bytes belong to the passage of the document's last word begun; those before its first word to none
    following = np.r_[words.start[1:], len(words.buf)]
    stop = np.minimum(following, words.base[words.doc + 1])
    text = words.buf[words.start[0]:]
    if (stop < following).any():
        text = text[np.repeat(np.tile([True, False], len(stop)), np.c_[stop - words.start, following - stop].ravel())]
    cell = np.repeat((at * _CLASSES).astype(np.int32), stop - words.start)
    cell += _CLASS[text]
    classes = np.bincount(cell, minlength=n * _CLASSES).reshape(n, _CLASSES)
    total = np.maximum(classes.sum(axis=1, keepdims=True), 1)
    # shares spread over orders of magnitude: their square roots are compared
    out[:, :_CLASSES] = np.sqrt(classes / total)
    some = np.maximum(count, 1)
    length = words.length.astype(float)
    mean = np.bincount(at, length, n) / some
    spread = np.sqrt(np.maximum(np.bincount(at, length ** 2, n) / some - mean ** 2, 0))
    head, tail = words.buf[words.start], words.buf[words.end - 1]
    same = np.zeros(len(at))
    same[1:] = (words.code[1:] == words.code[:-1]) & (at[1:] == at[:-1])
    pair = np.sort(mix(at.astype(np.uint64)) ^ words.code)
    key = mix(at.astype(np.uint64)) ^ words.code
    order = np.argsort(key, kind="stable")
    fresh = np.ones(len(at))
    fresh[order[1:]] = pair[1:] != pair[:-1]
    for k, x in enumerate((
        np.log1p(mean), np.log1p(spread), np.bincount(at, same, n) / some, np.bincount(at, fresh, n) / some,
        np.bincount(at, (head >= 65) & (head <= 90), n) / some,
        np.bincount(at, ~(((tail | 32) >= 97) & ((tail | 32) <= 122)) & (tail < 128), n) / some,
        np.bincount(at, length == 1, n) / some, np.log1p(count),
    )):
        out[:, _CLASSES + k] = x
    return doc, out


def _bags(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    for i, j, buf, base in slices(texts, SLICE_BYTES):
        yield i, j, *passages(Words(buf, base))


def _sig(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


@dataclass
class Model:
    """Weights of the network; ``share`` alone where nothing could be learned."""

    share: float
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: dict[str, np.ndarray] | None = None

    def embed(self, x: np.ndarray) -> np.ndarray:
        w = self.weights
        return np.tanh(np.clip((x - self.mean) / self.scale, -5, 5) @ w["E"] + w["e"])

    def score(self, doc: np.ndarray, x: np.ndarray, n: int) -> np.ndarray:
        """Score per document (passages of a document stand together)."""
        if self.weights is None:
            return np.full(n, self.share)
        first = np.searchsorted(doc, np.arange(n))
        return _forward(self.weights, self.embed(x), doc, first)[0]


def _forward(w, h, doc, first):
    t, g = np.tanh(h @ w["V"]), _sig(h @ w["U"])
    a = (t * g) @ w["w"]
    a = np.exp(a - np.maximum.reduceat(a, first)[doc])
    a /= np.add.reduceat(a, first)[doc]
    z = np.add.reduceat(a[:, None] * h, first, axis=0)
    return _sig(z @ w["c"] + w["b"][0]), a, z, t, g


def _gradient(w, x, doc, first, labels, weights):
    """Gradient of the weighted mean log loss over a few documents; ``x`` holds
    the standardised passages, ``first`` each document's first."""
    h = np.tanh(x @ w["E"] + w["e"])
    p, a, z, t, g = _forward(w, h, doc, first)
    d = (p - labels) * weights / len(first)
    dz = d[:, None] * w["c"]
    da = (dz[doc] * h).sum(axis=1)
    ds = a * (da - np.add.reduceat(a * da, first)[doc])
    dt, dg = ds[:, None] * w["w"] * g * (1 - t * t), ds[:, None] * w["w"] * t * g * (1 - g)
    dh = a[:, None] * dz[doc] + dt @ w["V"].T + dg @ w["U"].T
    dx = dh * (1 - h * h)
    return {"E": x.T @ dx, "e": dx.sum(axis=0), "V": h.T @ dt, "U": h.T @ dg,
            "w": ((t * g) * ds[:, None]).sum(axis=0), "c": z.T @ d, "b": np.array([d.sum()])}


def fit(bags: list[np.ndarray], labels: np.ndarray, seed: int = 1, weights: np.ndarray | None = None) -> Model:
    """Fit by Adam on the mean log loss, each document at its weight (small
    bags on the driver: ``train`` gives at most ``PASSAGES`` passages)."""
    weights = np.ones(len(labels)) if weights is None else weights
    share = float(np.average(labels, weights=weights)) if len(labels) else 1.0
    if len(set(labels.tolist())) < 2:
        return Model(share)
    weights = weights / weights.mean()
    rng = np.random.default_rng(seed)
    every = np.concatenate(bags)
    model = Model(share, every.mean(axis=0), every.std(axis=0) + 1e-3)
    w = model.weights = {
        "E": rng.normal(0, WIDTH ** -0.5, (WIDTH, EMBED)), "e": np.zeros(EMBED),
        "V": rng.normal(0, EMBED ** -0.5, (EMBED, GATE)), "U": rng.normal(0, EMBED ** -0.5, (EMBED, GATE)),
        "w": rng.normal(0, GATE ** -0.5, GATE), "c": rng.normal(0, EMBED ** -0.5, EMBED), "b": np.zeros(1)}
    state = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in w.items()}
    scaled = [np.clip((b - model.mean) / model.scale, -5, 5) for b in bags]
    step = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(bags))
        rate = RATE * (1 - epoch / EPOCHS)
        for i in range(0, len(order), BATCH):
            pick = order[i: i + BATCH]
            x = np.concatenate([scaled[k] for k in pick])
            sizes = np.array([len(scaled[k]) for k in pick])
            doc = np.repeat(np.arange(len(pick)), sizes)
            first = np.r_[0, np.cumsum(sizes)[:-1]]
            grad = _gradient(w, x, doc, first, labels[pick], weights[pick])
            step += 1
            for k, v in w.items():
                m, s = state[k]
                m += 0.1 * (grad[k] - m)
                s += 0.001 * (grad[k] ** 2 - s)
                v -= rate * (m / (1 - 0.9 ** step) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8) + DECAY * v)
    return model


def _bag_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rb in batches:
        bags, labels = [], rb.column("quality").to_pylist()
        for i, j, doc, x in _bags(rb.column("text")):
            for k in range(j - i):
                bag = x[doc == k] if j - i == 1 else x[np.searchsorted(doc, k): np.searchsorted(doc, k + 1)]
                bags.append(bag.astype(np.float32).tobytes())
        n = [len(b) // (4 * WIDTH) for b in bags]
        yield pa.RecordBatch.from_arrays([rb.column("doc_id"), pa.array(labels, pa.int32()), pa.array(n, pa.int32()), pa.array(bags, pa.large_binary())],
                                         ["doc_id", "quality", "n", "bag"])


def _affordable(sizes: pd.DataFrame, most: int) -> dict[int, int]:
    """Of ``(quality, h, n)``, the largest hash taken of each label: as many
    documents as hold ``most`` passages in all, the same share of every label
    and one of each at least."""
    sizes = sizes.sort_values(["quality", "h"])
    rank = sizes.groupby("quality").cumcount()
    sizes = sizes.assign(at=np.where(rank == 0, -1.0, rank / sizes.groupby("quality")["h"].transform("size"))).sort_values(["at", "quality"])
    taken = sizes[(sizes["at"] < 0) | (sizes["n"].cumsum() <= most)]
    return {int(q): int(h) for q, h in taken.groupby("quality")["h"].max().items()}


def train(docs: DataFrame, labels: DataFrame, n: int = TRAIN_DOCS, most: int = PASSAGES) -> Model:
    """Learn from ``labels (doc_id, quality)`` and the documents' texts."""
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    sizes = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    drawn = F.lit(False)
    for label, size in sizes.items():
        drawn = drawn | ((F.col("quality") == label) & hash_sample(F.xxhash64("doc_id"), n, size))
    known = known.where(drawn)
    # at most about n rows of 12 bytes a label
    read = stored(docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
                  .select("doc_id", "text", "quality").mapInArrow(_bag_task, "doc_id long, quality int, n int, bag binary"), "bags") \
        .withColumn("h", F.xxhash64("doc_id"))
    found = read.groupBy("quality", "h").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("rows")).toPandas()
    drew = found.groupby("quality")["rows"].sum()
    if found["n"].sum() > most:
        taken = F.lit(False)
        for label, last in _affordable(found, most).items():
            taken = taken | ((F.col("quality") == label) & (F.col("h") <= last))
        read = read.where(taken)
    rows = read.select("doc_id", "quality", "bag").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["bag"]))  # the order of arrival must not change the fit
    bags = [np.frombuffer(r["bag"], np.float32).reshape(-1, WIDTH).astype(float) for r in rows]
    got = pd.Series([r["quality"] for r in rows], dtype=int)
    stands_for = {q: max(1.0, sizes[q] / n) * drew[q] / k for q, k in got.value_counts().items()}
    return fit(bags, got.to_numpy(dtype=float), weights=got.map(stands_for).to_numpy(dtype=float))


def _score_task(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            scores = [model.score(doc, x, j - i) for i, j, doc, x in _bags(rb.column("__text"))]
            score = np.concatenate(scores) if scores else np.empty(0)
            yield pa.RecordBatch.from_arrays([*rb.columns[:-1], pa.array(score)], [*rb.schema.names[:-1], "__score"])
    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` in a struct ``row``, and ``score`` of its whole text."""
    flat = docs.select(F.struct("*").alias("row"), F.col("text").alias("__text"))
    schema = flat.select("row", F.lit(0.0).alias("__score")).schema
    return flat.mapInArrow(_score_task(model), schema).withColumnRenamed("__score", "score")
