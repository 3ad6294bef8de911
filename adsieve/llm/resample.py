"""Importance resampling towards a target distribution, by hashed n-grams.

1. *Features.* A text's features are all runs of 1 to ``GRAMS`` consecutive
   words (A-Z lower-cased; words are runs of ASCII letters and digits and of
   all characters beyond ASCII), joined by one space. A task numbers the
   distinct words of a slice, then the distinct pairs and triples of numbers,
   so every distinct feature is hashed once.
2. *CRC.* The bytes of the distinct features are grouped by equal length into
   two-dimensional arrays; all CRC-32 states of an array advance together,
   column by column. The bucket is the CRC modulo ``BUCKETS``; buckets are
   scattered back to the occurrences through the numbering.
3. *Counts.* Tasks count their buckets first and send one row a bucket, which
   Spark sums over all documents and over all target texts.
4. *Gains, weights.* ``floor(1000 ln((t+1)(S+BUCKETS) / ((s+1)(T+BUCKETS))))``
   is a bucket's gain; a document's weight is the sum over its features.
5. *Draw.* A Gumbel variate derived from the document id is added to the
   weight, and the highest scores are drawn without replacement. Ranks come
   from a range partitioning of narrow rows by score and the partitions'
   counts; no task sees all rows.

Defined results: a null or wordless text has no features, weight 0, and is
never drawn. Rows of equal score rank by ``doc_id`` (a missing id last), then
by feature count; repeated rows rank one after the other. Missing ids draw the
variate of the empty id. An empty target has T = 0 (every gain follows from the
formula). Other columns are ignored by ``scores``; ``resample`` keeps them.
Memory of a task is bounded by a slice of ``SLICE_BYTES`` or one word: longer
texts are cut between words, with the last words of a piece carried over.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adsieve.llm.common import partitions_for, stored
from adsieve.llm.textcodes import slices

GRAMS = 3
BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
SLICE_BYTES = 2 << 20
MATRIX_BYTES = 8 << 20
RANK_ROWS = 1 << 21  # of a range partition
_BLOCK = 256  # long features advance in blocks of so many bytes
_POLYNOMIAL = 0xEDB88320

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True


def _step(state: np.ndarray, byte: np.ndarray | int) -> np.ndarray:
    return _TABLE[(state ^ byte) & np.uint32(255)] ^ (state >> np.uint32(8))


def _table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> np.uint32(1)) ^ np.uint32(_POLYNOMIAL), t >> np.uint32(1))
    return t


_TABLE = _table()


def _skip_table() -> np.ndarray:
    """[byte of the state, its value]: the state ``_BLOCK`` zero bytes later."""
    s = (np.arange(256, dtype=np.uint32)[None, :] << (np.arange(4, dtype=np.uint32) * 8)[:, None]).ravel()
    for _ in range(_BLOCK):
        s = _step(s, 0)
    return s.reshape(4, 256)


_SKIP = _skip_table()


def _columns(state: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    for column in np.ascontiguousarray(matrix.T):
        state = _step(state, column)
    return state


def crc_matrix(matrix: np.ndarray) -> np.ndarray:
    """CRC-32 of every row of a two-dimensional array of bytes."""
    n, length = matrix.shape
    state = np.full(n, 0xFFFFFFFF, np.uint32)
    if length <= 4 * _BLOCK:
        return ~_columns(state, matrix)
    # a long row: its blocks advance together from zero, then are chained (the state is linear)
    head = length % _BLOCK
    state = _columns(state, matrix[:, :head])
    blocks = matrix[:, head:].reshape(n, -1, _BLOCK)
    ends = _columns(np.zeros(n * blocks.shape[1], np.uint32), blocks.reshape(-1, _BLOCK)).reshape(n, -1)
    for end in ends.T:
        state = reduce(np.bitwise_xor, (_SKIP[k][(state >> np.uint32(8 * k)) & np.uint32(255)] for k in range(4))) ^ end
    return ~state


def crc32_of(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of every slice ``data[start: start + length]``."""
    out = np.empty(len(start), np.uint32)
    order = np.argsort(length, kind="stable")
    cut = np.flatnonzero(np.diff(length[order], prepend=-1))
    for a, b in zip(cut, [*cut[1:], len(order)]):
        size = int(length[order[a]])
        rows = max(1, MATRIX_BYTES // max(size, 1))
        for x in range(a, b, rows):
            pick = order[x: min(x + rows, b)]
            out[pick] = crc_matrix(data[start[pick][:, None] + np.arange(size)])
    return out


def _number_words(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of each word, first occurrence of each number), exact."""
    number, firsts, n = np.empty(len(start), np.int64), [], 0
    order = np.argsort(length, kind="stable")
    cut = np.flatnonzero(np.diff(length[order], prepend=-1))
    for a, b in zip(cut, [*cut[1:], len(order)]):
        pick, size = order[a:b], int(length[order[a]])
        wide = np.zeros((len(pick), -(-size // 8) * 8), np.uint8)
        wide[:, :size] = data[start[pick][:, None] + np.arange(size)]
        parts = wide.view(np.uint64)
        key = parts[:, 0].copy()
        for part in parts.T[1:]:
            key = (key ^ (key >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + part
        _, first, inverse = np.unique(key, return_index=True, return_inverse=True)
        if parts.shape[1] > 1 and (parts != parts[first[inverse]]).any():  # two words of one key
            _, first, inverse = np.unique(np.ascontiguousarray(wide).view(f"V{wide.shape[1]}").ravel(), return_index=True, return_inverse=True)
        number[pick] = n + inverse
        firsts.append(pick[first])
        n += len(first)
    return number, (np.concatenate(firsts) if firsts else np.empty(0, np.int64))


class Features:
    """Features of a run of documents (``base``: byte offset of each in
    ``buf``). The first ``lead`` words only precede the others: features that
    end within them are left out.

    ``words``: words per document; ``bucket``, ``count``: of each distinct
    feature; ``per_size``: (document, index of the distinct feature) of every
    occurrence, by feature size."""

    def __init__(self, buf: np.ndarray, base: np.ndarray, lead: int = 0):
        buf = _LOWER[buf]
        inside = _WORD[buf]
        begin = inside.copy()
        if len(buf):
            begin[1:] &= ~inside[:-1]
            edge = base[1:-1]
            edge = edge[edge < len(buf)]
            begin[edge] = inside[edge]
        at = np.flatnonzero(begin)
        doc = np.searchsorted(base, at, side="right") - 1
        # words with one space after each: every feature is one slice of this
        kept = buf[inside]
        word = np.cumsum(begin[inside]) - 1
        length = np.bincount(word, minlength=len(at)).astype(np.int64)
        data = np.full(len(kept) + len(at), 32, np.uint8)
        data[np.arange(len(kept)) + word] = kept
        start = np.cumsum(length) - length + np.arange(len(at))
        self.words = np.bincount(doc, minlength=len(base) - 1)
        if lead:
            self.words[0] -= lead
        number, first = _number_words(data, start, length)
        distinct, index, from_, to = len(first), number, [start[first]], [start[first] + length[first]]
        self.per_size = [(doc[lead:], number[lead:])]
        seen = distinct
        for size in range(2, GRAMS + 1):
            n = len(at) - size + 1
            if n <= 0:
                break
            here = np.flatnonzero(doc[:n] == doc[size - 1:])
            # a feature is the feature without its last word, and that word
            key = index[here] * distinct + number[here + size - 1]
            _, first, inverse = np.unique(key, return_index=True, return_inverse=True)
            head = here[first]
            from_.append(start[head])
            to.append(start[head + size - 1] + length[head + size - 1])
            keep = here + size - 1 >= lead
            self.per_size.append((doc[here][keep], seen + inverse[keep]))
            index = np.zeros(len(at), np.int64)
            index[here] = inverse
            seen += len(first)
        from_, to = np.concatenate(from_), np.concatenate(to)
        self.bucket = (crc32_of(data, from_, to - from_) % np.uint32(BUCKETS)).astype(np.int64)
        self.count = sum(np.bincount(f, minlength=len(from_)) for _, f in self.per_size)


def _pieces(buf: np.ndarray, limit: int) -> Iterator[tuple[np.ndarray, int]]:
    """A long text in pieces cut between words, each led by the last words of
    the one before (their number second)."""
    carried, lead, a = np.empty(0, np.uint8), 0, 0
    while a < len(buf):
        b = min(a + limit, len(buf))
        while b < len(buf) and _WORD[_LOWER[buf[b]]]:  # to the end of the word
            ahead = np.flatnonzero(~_WORD[_LOWER[buf[b: b + limit]]])
            b = b + int(ahead[0]) if len(ahead) else min(b + limit, len(buf))
        piece = np.concatenate([carried, buf[a:b]])
        yield piece, lead
        inside = _WORD[_LOWER[piece]]
        starts = np.flatnonzero(inside & ~np.r_[False, inside[:-1]])
        lead = min(GRAMS - 1, len(starts))
        carried = np.r_[piece[starts[-lead]:], np.uint8(32)] if lead else np.empty(0, np.uint8)
        a = b


def features(texts: pa.Array) -> Iterator[tuple[int, int, Features]]:
    """(from row, to row, features); a long text comes several times."""
    for i, j, buf, base in slices(texts, SLICE_BYTES):
        if j == i + 1 and len(buf) > SLICE_BYTES:
            for piece, lead in _pieces(buf, SLICE_BYTES):
                yield i, j, Features(piece, np.array([0, len(piece)]), lead)
        else:
            yield i, j, Features(buf, base)


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    for rb in batches:
        for _, _, f in features(rb.column("text")):
            # below 2**53, so exact
            total += np.bincount(f.bucket, f.count, BUCKETS).astype(np.int64)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """Features of all texts by bucket (``BUCKETS`` rows reach the driver)."""
    rows = texts.select("text").where("text is not null").mapInArrow(_count_task, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(BUCKETS, np.int64)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of each bucket, in thousandths."""
    s, t = source.astype(float), target.astype(float)
    return np.floor(1000 * np.log((t + 1) * (float(source.sum()) + BUCKETS) / ((s + 1) * (float(target.sum()) + BUCKETS)))).astype(np.int64)


def _weight_task(gain: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            words, found, weight = (np.zeros(rb.num_rows, np.int64) for _ in range(3))
            for i, j, f in features(rb.column("__text")):
                worth = gain[f.bucket].astype(float)
                words[i:j] += f.words
                for doc, index in f.per_size:
                    found[i:j] += np.bincount(doc, minlength=j - i)
                    weight[i:j] += np.bincount(doc, worth[index], j - i).astype(np.int64)  # whole numbers below 2**53
            yield pa.RecordBatch.from_arrays([*rb.columns[:-1], *map(pa.array, (words, found, weight))],
                                             [*rb.schema.names[:-1], "n_words", "n_features", "weight"])
    return run


def _score(doc_id: Column, weight: Column) -> Column:
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{SEED}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    return weight + noise.cast("long")


def weights(docs: DataFrame, target: DataFrame) -> DataFrame:
    """Struct ``row`` of all columns of ``docs``, with ``n_words, n_features,
    weight, score`` of its text against the texts of ``target``."""
    gain = gains(bucket_counts(docs), bucket_counts(target))
    flat = docs.select(F.struct("*").alias("row"), F.col("text").alias("__text"))
    schema = flat.select("row", *(F.lit(0).cast("long").alias(c) for c in ("n_words", "n_features", "weight"))).schema
    return flat.mapInArrow(_weight_task(gain), schema).withColumn("score", _score(F.col("row.doc_id"), F.col("weight")))


def ranked(rows: DataFrame) -> DataFrame:
    """``rows (doc_id, n_features, score, ...)`` with ``rank`` 1, 2, 3 ... from
    the highest score down; one shuffle, every task ranks its own range."""
    spark = rows.sparkSession
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("salt")]
    parts = partitions_for(spark, rows.count(), RANK_ROWS)
    # the salt splits rows that repeat, however many
    dealt = rows.withColumn("salt", F.xxhash64(F.monotonically_increasing_id())).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed = stored(dealt.withColumn("at", F.monotonically_increasing_id()), "ranked") \
        .withColumn("part", F.shiftright("at", 33)).withColumn("at", F.col("at").bitwiseAND((1 << 33) - 1))
    before, offsets = 0, []
    for r in placed.groupBy("part").count().orderBy("part").collect():  # one row a partition
        offsets.append((r["part"], before))
        before += r["count"]
    side = spark.createDataFrame(offsets, "part long, before long")
    return placed.join(F.broadcast(side), "part").withColumn("rank", F.col("before") + F.col("at") + 1).select(*rows.columns, "rank")


def scores(docs: DataFrame, target: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_features, weight, score, rank, n_words`` of every row of
    ``docs``; ``rank`` is null where the row is not drawn."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    told = stored(weights(docs, target.select("text")).select("row.doc_id", "n_features", "weight", "score", "n_words"), "weights")
    fit = told.where(F.col("n_words") >= LEAST_WORDS)
    most = percent * fit.count() // 100
    rest = told.where(F.col("n_words") < LEAST_WORDS).withColumn("rank", F.lit(None).cast("long"))
    return ranked(fit).withColumn("rank", F.when(F.col("rank") <= most, F.col("rank"))).unionByName(rest) \
        .select("doc_id", "n_features", "weight", "score", "rank", "n_words")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The drawn rows of ``docs``, all columns. Rows are scored where they lie
    and compared with the last one drawn, so no text is shuffled; rows that
    repeat that one's id and score stay with it."""
    last = scores(docs, target, percent).where("rank is not null").orderBy(F.desc("rank")).select("score", "doc_id").first()
    if last is None:
        return docs.limit(0)
    told = weights(docs, target).where(F.col("n_words") >= LEAST_WORDS)
    i, end = F.col("row.doc_id").cast("long"), last["doc_id"]
    in_time = F.lit(True) if end is None else F.coalesce(i <= end, F.lit(False))
    return told.where((F.col("score") > last["score"]) | ((F.col("score") == last["score"]) & in_time)).select("row.*")
