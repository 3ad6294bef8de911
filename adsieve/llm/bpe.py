"""BPE encoding by tree concatenation, and decoding.

Texts of up to ``PIECE_CHARS`` are encoded whole. A longer text is halved until
its pieces are that short, wherever the cuts fall; the pieces become rows of
their own and are encoded in parallel. The encodings are then joined as a
binary tree. At each join a window around the cut is encoded anew and doubled
until it shares a token (same id and characters) with the left side and one
with the right side, both clear of all edges. What stands between these two
tokens is taken from the window. Every neighbouring pair of tokens in the
result then occurs in a true encoding, which makes it *the* encoding. A window
that reaches an end of its side is right there as it is.

Defined results: a null text counts as empty and has no ids. Rows of equal id
are encoded each for itself. Input columns named ``ids`` (`encode`) or
``decoded`` (`decode`) are replaced.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adsieve.llm.common import others
from adsieve.llm.tokens import WordEncoder, encoder, load

PIECE_CHARS = 1 << 16
WINDOW = 64
# longest look of the pre-tokenizer past a place: a special token's text
MARGIN = 16

Encoding = tuple[np.ndarray, np.ndarray, np.ndarray]  # ids, starts, ends (characters)


def halves(n: int, piece: int = PIECE_CHARS) -> list[int]:
    """Cuts of a text of ``n`` characters: halved until no piece is longer."""
    leaves = 1
    while n > leaves * piece:
        leaves *= 2
    return [i * n // leaves for i in range(leaves + 1)]


def _starter(text: str, at: int) -> bool:
    """Nothing that stands before ``at`` can combine with what follows."""
    if at >= len(text):
        return True
    c = text[at]
    return not unicodedata.category(c).startswith("M") and not "ᅠ" <= c <= "ᇿ"


def _shared(text: str, side: Encoding, window: Encoding, lo: int, hi: int, last: bool) -> tuple[int, int] | None:
    """(index in side, index in window) of a token that both have inside [lo, hi)."""
    ids, s, e = side
    at = {(int(a), int(b), int(t)): k for k, (t, a, b) in enumerate(zip(*window))}
    a, b = np.searchsorted(s, lo), np.searchsorted(s, hi)
    for k in (range(b - 1, a - 1, -1) if last else range(a, b)):
        w = at.get((int(s[k]), int(e[k]), int(ids[k])))
        if w is None or e[k] > hi or s[k] < lo or s[k] == e[k]:
            continue
        clear = all(
            (i == 0 or x[2][i - 1] <= s[k]) and (i + 1 == len(x[0]) or x[1][i + 1] >= e[k])
            for x, i in ((side, k), (window, w)))
        if clear and _starter(text, int(s[k])) and _starter(text, int(e[k])):
            return int(k), w
    return None


def join_at(text: str, left: Encoding, right: Encoding, begin: int, cut: int, end: int, encode, window: int = WINDOW) -> Encoding:
    """Encoding of ``text[begin:end]`` from those of its two sides."""
    while True:
        lo, hi = max(begin, cut - window), min(end, cut + window)
        w = encode(text[lo:hi])
        w = w[0], w[1] + lo, w[2] + lo
        a = (0, 0) if lo == begin else _shared(text, left, w, lo + MARGIN, cut - MARGIN, True)
        z = (len(right[0]), len(w[0])) if hi == end else _shared(text, right, w, cut + MARGIN, hi - MARGIN, False)
        if a is not None and z is not None:
            return tuple(np.concatenate([x[: a[0]], y[a[1]: z[1]], r[z[0]:]]) for x, y, r in zip(left, w, right))
        window *= 2


def concatenate(text: str, cuts: list[int], pieces: list[Encoding], encode) -> Encoding:
    """Join the pieces as a binary tree."""
    if len(pieces) == 1:
        return pieces[0]
    mid = len(pieces) // 2
    left = concatenate(text, cuts[: mid + 1], pieces[:mid], encode)
    right = concatenate(text, cuts[mid:], pieces[mid:], encode)
    return join_at(text, left, right, cuts[0], cuts[mid], cuts[-1], encode)


def _lists(ids: list[bytes]) -> pa.ListArray:
    sizes = np.array([len(x) // 4 for x in ids], dtype=np.int64)
    flat = np.frombuffer(b"".join(ids), dtype="<i4")
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), pa.array(flat, pa.int32()))


def _encode_whole(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(WordEncoder, path)
        for rb in batches:
            ids = [enc.ids(t) for t in rb.column("__text").to_pylist()]
            rest = [rb.column(i) for i in range(rb.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*rest, _lists(ids)], [*rb.schema.names[:-1], "ids"])
    return run


def _cut(piece: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for doc, text in zip(rb.column("__doc").to_pylist(), rb.column("__text").to_pylist()):
                cuts = halves(len(text), piece)
                yield pa.RecordBatch.from_pydict({
                    "__doc": pa.array([doc] * (len(cuts) - 1), pa.string()), "at": pa.array(cuts[:-1], pa.int64()),
                    "piece": [text[a:b] for a, b in zip(cuts, cuts[1:])]})
    return run


def _encode_pieces(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(WordEncoder, path)
        for rb in batches:
            got = [[x.astype(np.int32).tobytes() for x in enc.with_edges(t)] for t in rb.column("piece").to_pylist()]
            yield pa.RecordBatch.from_arrays([*rb.columns, *(pa.array(x, pa.binary()) for x in zip(*got))],
                                             [*rb.schema.names, "ids", "starts", "ends"])
    return run


def _join_pieces(path: str):
    def run(table: pa.Table) -> pa.Table:
        enc = encoder(WordEncoder, path)
        table = table.sort_by("at")
        text = "".join(table["piece"].to_pylist())
        cuts = [*table["at"].to_pylist(), len(text)]
        cols = [[np.frombuffer(b, np.int32) for b in table[c].to_pylist()] for c in ("ids", "starts", "ends")]
        pieces = [(i, s.astype(np.int64) + at, e.astype(np.int64) + at) for i, s, e, at in zip(*cols, cuts)]
        ids = concatenate(text, cuts, pieces, enc.with_offsets)[0]
        return pa.table({"__doc": table["__doc"][:1], "ids": _lists([ids.astype("<i4").tobytes()])})
    return run


def encode(docs: DataFrame, path: str, piece: int = PIECE_CHARS) -> DataFrame:
    """``docs`` plus ``ids`` (array of int), as the library encodes each whole
    text without special tokens. ``path`` names the tokenizer's file."""
    rest = others(docs, "ids")
    text = F.coalesce("text", F.lit(""))
    names = [f"c{i}" for i in range(len(rest))]
    kinds = [f.dataType for f in docs.select(*rest).schema.fields]
    flat = docs.select(*[c.alias(n) for c, n in zip(rest, names)], text.alias("__text"))
    schema = T.StructType([T.StructField(n, k) for n, k in zip(names, kinds)] + [T.StructField("ids", T.ArrayType(T.IntegerType()))])
    short = flat.where(F.length("__text") <= piece).mapInArrow(_encode_whole(path), schema)
    # equal texts have equal ids, so a text's digest names its pieces
    long = flat.where(F.length("__text") > piece).withColumn("__doc", F.sha2(F.encode("__text", "UTF-8"), 256))
    pieces = long.select("__doc", "__text").dropDuplicates(["__doc"]).mapInArrow(_cut(piece), "__doc string, at long, piece string")
    joined = (
        pieces.repartition("__doc", "at").mapInArrow(_encode_pieces(path), "__doc string, at long, piece string, ids binary, starts binary, ends binary")
        .groupBy("__doc").applyInArrow(_join_pieces(path), "__doc string, ids array<int>")
    )
    out = short.unionByName(long.drop("__text").join(joined, "__doc").drop("__doc"))
    labels = [f.name for f in docs.select(*rest).schema.fields]
    return out.select(*[F.col(n).alias(x) for n, x in zip(names, labels)], "ids")


def decode(df: DataFrame, path: str) -> DataFrame:
    """``df`` plus ``decoded``: the library's text of ``ids``, special tokens kept."""
    def texts(ids):
        tok = load(path)
        return ids.map(lambda x: tok.decode(x.tolist(), skip_special_tokens=False) if x is not None else None)

    return df.select(*others(df, "decoded"), F.pandas_udf(texts, "string")("ids").alias("decoded"))
