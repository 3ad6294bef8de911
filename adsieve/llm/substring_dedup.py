"""Substring dedup: Rabin-Karp codes of every window of ``width`` words.

1. *Hash.* Tasks hash all windows of their documents (`textcodes`): a 64-bit
   code, and a bucket number from a second polynomial. Windows that repeat
   inside one slice of input are settled there, and windows that the task sent
   before are settled against what it sent (`_Seen`), so a passage that fills a
   third of the corpus reaches its bucket about once per task. The rest is
   shuffled by bucket as packed arrays of (code, document, position).
2. *Count.* A bucket holds about ``BUCKET_WINDOWS`` windows, however large the
   input; buckets are groups in at most ``PARTITIONS`` partitions, handled one
   after the other. Every window whose code occurred before (smaller document,
   or same document and earlier start) is marked.
3. *Merge.* Marks are shuffled to their document's group and merged into
   maximal removal intervals.
4. *Cut.* Intervals are joined to the documents (broadcast below a measured
   size, else shuffled) and the covered words are cut out.

Codes agree only if 64 bits and the bucket agree, so the expected number of
false repeats is ``windows * BUCKET_WINDOWS / 2**65``: 4e-6 at 0.5 GB of
input, about one window at 100 TB.

Sizes at 100 TB (some 1.6e13 windows): 16 million buckets in 32,768 partitions.

Defined results: a null text has no words and stays null; texts shorter than
the window are never cut. Repeated rows (same id and text) count as one
document and are cut alike. Rows that share an id but not the text are
documents of their own, ordered after each other by a hash of the text
(``tagged``), so a passage stays in exactly one of them. Rows without id cannot
be ordered and pass unchanged. Input columns named ``n_words`` or ``n_removed``
are replaced. Memory of a task is bounded by a slice (1 MB of text or one
document, some 40 bytes a text byte) and a bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adsieve.llm.common import BROADCAST_BYTES, broadcast_if_small, fresh_names, others, partitions_for, stored
from adsieve.llm.textcodes import Words, planes, slices, unplanes

WIDTH = 20
SLICE_BYTES = 1 << 20
BUCKET_WINDOWS = 1 << 20
PARTITIONS = 1 << 15  # at most, so that the shuffle's bookkeeping stays bounded
SEEN = 1 << 19  # windows that a task remembers
_BYTES_PER_WORD = 6  # only sizes the buckets
_ENTRY = "key long, code binary, doc binary, tag binary, pos binary"
_CUT = "text string, n_words long, n_removed long"
_MARK = "grp long, doc binary, tag binary, pos binary"


def _groups(doc: np.ndarray, tag: np.ndarray, n: int) -> np.ndarray:
    # Fibonacci hashing spreads dense and sparse ids alike
    return (((doc ^ tag).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)) % np.uint64(n)


def _small(key: np.ndarray, n: int) -> np.ndarray:
    return key.astype(np.uint16) if n <= 1 << 16 else key  # 16-bit keys sort by radix


def _pack_pos(doc: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Differences to the entry before; positions start anew in each document."""
    d = np.diff(doc, prepend=np.int64(0))
    p = pos.astype(np.int32).copy()
    if len(p) > 1:
        same = d[1:] == 0
        p[1:][same] -= pos.astype(np.int32)[:-1][same]
    return d, p


def _unpack_pos(d: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    doc = np.cumsum(d)
    total = np.cumsum(p, dtype=np.int64)
    fresh = np.r_[True, d[1:] != 0]
    head = np.maximum.accumulate(np.where(fresh, np.arange(len(d)), 0))
    return doc, total - (total - p)[head]


def _blob_rows(key, n, doc, tag, pos, code=None):
    """Rows of ``_ENTRY``/``_MARK`` per key; entries are in (doc, tag, pos) order."""
    key = _small(key, n)
    order = np.argsort(key, kind="stable")
    key, doc, tag, pos = key[order], doc[order], tag[order], pos[order]
    code = code[order] if code is not None else None
    if not len(key):
        return
    plain = not tag.any()
    cut = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    for a, b in zip(cut, [*cut[1:], len(key)]):
        d, p = _pack_pos(doc[a:b], pos[a:b])
        yield int(key[a]), (None if code is None else code[a:b].tobytes()), planes(d), (b"" if plain else planes(tag[a:b])), planes(p)


def _sorted(doc, tag, pos, code=None):
    """Order by code (if given), then place."""
    keys = [pos] + ([tag] if tag.any() else []) + [doc] + ([code] if code is not None else [])
    return np.lexsort(keys)


def _after_head(doc, tag, pos, new):
    """Entries (sorted by code, then place) that are not at their code's first place."""
    head = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    return (doc != doc[head]) | (pos != pos[head]) | (tag != tag[head])


class _Seen:
    """Windows that this task sent to their buckets, as far as it remembers
    them: those of the last slice and those that came again before. A window
    at a later place than one that was sent is a repeat and need not be sent;
    what is forgotten is only sent once more."""

    def __init__(self) -> None:
        self.code = np.empty(0, np.uint64)
        self.rest = np.empty((0, 4), np.int64)  # bucket, doc, tag, pos
        self.again = np.empty(0, bool)

    def settle(self, code: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(to send, repeats) of distinct windows in the order of ``code``."""
        send, repeat = np.ones(len(code), bool), np.zeros(len(code), bool)
        fresh = send.copy()
        if len(self.code):
            at = np.minimum(np.searchsorted(self.code, code), len(self.code) - 1)
            hit = np.flatnonzero((self.code[at] == code) & (self.rest[at, 0] == rest[:, 0]))
            at = at[hit]
            old, now = self.rest[at, 1:], rest[hit, 1:]
            differs = old != now
            col = differs.argmax(axis=1)
            row = np.arange(len(hit))
            after = now[row, col] > old[row, col]
            earlier = differs.any(axis=1) & ~after
            send[hit], repeat[hit], fresh[hit] = earlier, after, False
            self.rest[at[earlier]] = rest[hit[earlier]]
            self.again[at] = True
        keep = self.again
        if keep.sum() > SEEN:  # begin anew rather than grow
            keep = np.zeros(len(keep), bool)
        code = np.r_[self.code[keep], code[fresh][:SEEN]]
        order = np.argsort(code, kind="stable")
        self.rest = np.concatenate([self.rest[keep], rest[fresh][:SEEN]])[order]
        self.again = np.r_[np.ones(keep.sum(), bool), np.zeros(len(code) - keep.sum(), bool)][order]
        self.code = code[order]
        return send, repeat


def _hash_task(width: int, buckets: int, groups: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("key", pa.int64())] + [(c, pa.binary()) for c in ("code", "doc", "tag", "pos")])
        seen = _Seen()
        for rb in batches:
            rows = pa.Table.from_batches([rb])
            rows = rows.filter(rows["doc_id"].is_valid()).sort_by([("doc_id", "ascending"), ("tag", "ascending")])
            if not rows.num_rows:
                continue
            ids, tags = (rows[c].combine_chunks().to_numpy(zero_copy_only=False).astype(np.int64) for c in ("doc_id", "tag"))
            texts = rows["text"].combine_chunks()
            texts = texts.chunk(0) if isinstance(texts, pa.ChunkedArray) else texts
            for i, j, buf, base in slices(texts, SLICE_BYTES):
                w = Words(buf, base)
                at, c1 = w.windows(width, 0)
                if not len(at):
                    continue
                bucket = w.windows(width, 1)[1] % np.uint64(buckets)
                owner = w.doc[at]
                doc, tag = ids[i:j][owner], tags[i:j][owner]
                pos = at - w.first[owner]
                del w, owner, at  # only the windows' arrays are needed from here
                order = np.argsort(c1, kind="stable")
                c, b = c1[order], bucket[order]
                new = np.r_[True, (c[1:] != c[:-1]) | (b[1:] != b[:-1])]
                marked = np.zeros(len(c1), bool)
                marked[order] = _after_head(doc[order], tag[order], pos[order], new)
                first = order[new]
                send, repeat = seen.settle(c[new], np.stack([b[new].astype(np.int64), doc[first], tag[first], pos[first]], axis=1))
                marked[first[repeat]] = True
                first = np.sort(first[send])
                out = list(_blob_rows(bucket[first], buckets, doc[first], tag[first], pos[first], c1[first]))
                if marked.any():
                    doc, tag, pos = doc[marked], tag[marked], pos[marked]
                    out += [(-1 - k, *rest) for k, *rest in _blob_rows(_groups(doc, tag, groups), groups, doc, tag, pos)]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), schema.types)], schema=schema)
    return run


def _entries(table: pa.Table, coded: bool):
    parts = []
    for d, t, p in zip(table["doc"].to_pylist(), table["tag"].to_pylist(), table["pos"].to_pylist()):
        doc, pos = _unpack_pos(unplanes(d, np.int64), unplanes(p, np.int32))
        parts.append((doc, unplanes(t, np.int64) if t else np.zeros(len(doc), np.int64), pos))
    doc, tag, pos = (np.concatenate(x) for x in zip(*parts))
    if not coded:
        return doc, tag, pos
    return doc, tag, pos, np.concatenate([np.frombuffer(c, np.uint64) for c in table["code"].to_pylist()])


def _count_task(groups: int):
    schema = pa.schema([("grp", pa.int64())] + [(c, pa.binary()) for c in ("doc", "tag", "pos")])

    def run(table: pa.Table) -> pa.Table:
        key = table["key"][0].as_py()
        if key < 0:  # marks settled before the shuffle
            return pa.table([pa.array([-1 - key] * table.num_rows, pa.int64()), table["doc"], table["tag"], table["pos"]], schema=schema)
        doc, tag, pos, code = _entries(table, True)
        order = _sorted(doc, tag, pos, code)
        doc, tag, pos, code = doc[order], tag[order], pos[order], code[order]
        marked = _after_head(doc, tag, pos, np.r_[True, code[1:] != code[:-1]])
        doc, tag, pos = doc[marked], tag[marked], pos[marked]
        order = _sorted(doc, tag, pos)
        doc, tag, pos = doc[order], tag[order], pos[order]
        out = [(k, *rest) for k, _, *rest in _blob_rows(_groups(doc, tag, groups), groups, doc, tag, pos)]
        return pa.table([pa.array(x, t) for x, t in zip(zip(*out) if out else [[]] * 4, schema.types)], schema=schema)
    return run


def _merge_task(width: int):
    schema = pa.schema([("doc_id", pa.int64()), ("tag", pa.int64()), ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32()))])

    def run(table: pa.Table) -> pa.Table:
        doc, tag, pos = _entries(table, False)
        order = _sorted(doc, tag, pos)
        doc, tag, pos = doc[order], tag[order], pos[order]
        fresh = np.r_[True, (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])]
        # intervals that overlap or touch become one
        begin = np.flatnonzero(fresh | np.r_[True, pos[1:] > pos[:-1] + width])
        last = np.r_[begin[1:], len(doc)] - 1
        starts, ends = pos[begin].astype(np.int32), (pos[last] + width).astype(np.int32)
        at = np.flatnonzero(fresh[begin])
        offsets = pa.array(np.r_[at, len(begin)].astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (starts, ends)]
        return pa.table([pa.array(doc[begin][at]), pa.array(tag[begin][at]), *lists], schema=schema)
    return run


def tagged(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a column that tells the texts of one id apart: 0 where the
    id has one text, else a hash of the text. Ids of several texts are looked
    up in a broadcast of checked size; beyond it every row gets its hash."""
    h = F.xxhash64(F.coalesce("text", F.lit("")))
    clash = docs.select("doc_id", h.alias("h")).where("doc_id is not null").groupBy("doc_id").agg(F.min("h").alias("a"), F.max("h").alias("b"))
    clash = stored(clash.where("a <> b").select(F.col("doc_id").alias(name)), "clash")
    n = clash.count()
    if not n:
        return docs.withColumn(name, F.lit(0).cast("long"))
    if n * 24 > BROADCAST_BYTES:
        return docs.withColumn(name, h)
    joined = docs.join(F.broadcast(clash), F.col("doc_id") == F.col(name), "left")
    return joined.withColumn(name, F.when(F.col(name).isNull(), F.lit(0).cast("long")).otherwise(h))


def repeated_spans(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``(doc_id, tag, starts, ends)`` of ``docs (doc_id, text, tag)``: maximal
    word intervals to remove."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = partitions_for(spark, size // _BYTES_PER_WORD, BUCKET_WINDOWS)
    parts = min(n, PARTITIONS)
    marks = (
        docs.select("doc_id", "text", "tag").mapInArrow(_hash_task(width, n, n), _ENTRY)
        .repartition(parts, "key").groupBy("key").applyInArrow(_count_task(n), _MARK)
    )
    return marks.repartition(parts, "grp").groupBy("grp").applyInArrow(_merge_task(width), "doc_id long, tag long, starts array<int>, ends array<int>")


def _cut(texts: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.DataFrame:
    out = []
    for text, a, b in zip(texts, starts, ends):
        raw = (text or "").encode()
        if a is None:
            out.append((text, len(raw.split()), 0))
            continue
        w = Words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        n = len(w.start)
        keep_from, keep_to = np.r_[0, b], np.r_[a, n]
        runs = [raw[w.start[x]: w.end[y - 1]] for x, y in zip(keep_from, keep_to) if x < y]
        out.append((b" ".join(runs).decode(), n, int((np.asarray(b) - np.asarray(a)).sum())))
    return pd.DataFrame(out, columns=["text", "n_words", "n_removed"])


def dedup_substrings(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` with repeated words cut from ``text``, plus ``n_words`` (before)
    and ``n_removed``. Kept words keep the white space between them; where
    words were cut, one space joins what is left. Uncut texts are unchanged."""
    tag, key, own, a, b, cut = fresh_names(docs, "tag", "key", "own", "a", "b", "cut")
    rows = tagged(docs, tag)
    spans = stored(repeated_spans(rows.select("doc_id", "text", F.col(tag).alias("tag")), width), "spans")
    size = spans.agg(F.count(F.lit(1)), F.sum(F.size("starts"))).first()
    side = spans.select(F.col("doc_id").alias(key), F.col("tag").alias(own), F.col("starts").alias(a), F.col("ends").alias(b))
    side = broadcast_if_small(side, size[0] * 48 + (size[1] or 0) * 8, 1)
    done = rows.join(side, (F.col("doc_id") == F.col(key)) & (F.col(tag) == F.col(own)), "left") \
        .withColumn(cut, F.pandas_udf(_cut, _CUT)("text", a, b))
    return done.select(*others(docs, "text", "n_words", "n_removed"), cut + ".*")
