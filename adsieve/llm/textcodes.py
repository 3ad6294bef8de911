"""Vectorised word and window hashing over Arrow text buffers (numpy only).

Words are maximal runs outside ``[\\x20\\x09-\\x0D]`` of the UTF-8 bytes. A
word's 64-bit code is a multilinear hash of its bytes; a window's code is the
Rabin-Karp polynomial of its word codes, taken from prefix sums modulo 2**64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_U = np.uint64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
# odd bases of the two polynomials, with their inverses modulo 2**64
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finalizer (bijective)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _stream(n: int, seed: int) -> np.ndarray:
    return mix((np.arange(1, n + 1, dtype=_U) * _U(0x9E3779B97F4A7C15)) + _U(seed)) | _U(1)


class _Tables:
    """Grow-only tables: byte position multipliers, powers of the bases."""

    def __init__(self) -> None:
        self.mul = _stream(64, 7)
        self.pw = [np.ones(1, dtype=_U)] * 2
        self.inv = [np.ones(1, dtype=_U)] * 2

    def multipliers(self, n: int) -> np.ndarray:
        if len(self.mul) < n:
            self.mul = _stream(2 * n, 7)
        return self.mul

    def powers(self, k: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.pw[k]) < n:
            for store, base in ((self.pw, BASES[k]), (self.inv, pow(BASES[k], -1, 1 << 64))):
                t = np.full(n + n // 2 + 1, base, dtype=_U)
                t[0] = 1
                store[k] = np.cumprod(t, dtype=_U)
        return self.pw[k], self.inv[k]


_T = _Tables()


class Words:
    """Words of a run of documents.

    ``code``: code per word; ``doc``: document index per word; ``first``:
    index of each document's first word (length ``n_docs + 1``); ``start`` and
    ``end``: byte offsets per word in ``buf``; ``base``: byte offset of each
    document in ``buf``.
    """

    def __init__(self, buf: np.ndarray, base: np.ndarray):
        self.buf, self.base = buf, base
        n_docs = len(base) - 1
        space = _SPACE[buf]
        inside = ~space
        begin = inside.copy()
        if len(buf):
            begin[1:] &= space[:-1]
            edge = base[1:-1]
            edge = edge[edge < len(buf)]
            begin[edge] = inside[edge]
        self.start = np.flatnonzero(begin)
        n = len(self.start)
        if n:
            # place of each byte in its word (bytes before the first word: 0)
            pos = np.cumsum(begin, dtype=np.int32)
            pos -= 1
            pos = self.start.astype(np.int32)[np.maximum(pos, 0, out=pos)]
            np.subtract(np.arange(len(buf), dtype=np.int32), pos, out=pos)
            np.maximum(pos, 0, out=pos)
            val = _T.multipliers(int(pos.max()) + 1)[pos]
            del pos
            val *= buf.astype(np.uint16) + np.uint16(1)
            val *= inside
            # spaces before the first word carry no value
            self.code = mix(np.add.reduceat(val, self.start))
            self.length = np.add.reduceat(inside, self.start, dtype=np.int64)
        else:
            self.code = np.empty(0, dtype=_U)
            self.length = np.empty(0, dtype=np.int64)
        self.end = self.start + self.length
        self.first = np.searchsorted(self.start, base)
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(n_docs), self.counts)

    def windows(self, width: int, k: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(index of the first word, code) of every window of ``width`` words
        inside one document; ``k`` picks the polynomial."""
        n = len(self.code)
        if n < width:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=_U)
        pw, inv = _T.powers(k, n + 1)
        p = np.zeros(n + 1, dtype=_U)
        np.cumsum(self.code * pw[:n], out=p[1:])
        at = np.flatnonzero(self.doc[: n - width + 1] == self.doc[width - 1:])
        return at, mix((p[at + width] - p[at]) * inv[at])


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(data bytes, offsets) of a string array; null counts as empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    large = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offs, data = texts.buffers()
    kind = np.int64 if large else np.int32
    off = np.frombuffer(offs, dtype=kind)[texts.offset: texts.offset + len(texts) + 1].astype(np.int64) if offs else np.zeros(len(texts) + 1, np.int64)
    buf = np.frombuffer(data, dtype=np.uint8)[off[0]: off[-1]] if data else np.empty(0, np.uint8)
    return buf, off - off[0]


def slices(texts: pa.Array, limit: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string array into runs of at most ``limit`` bytes (a longer text
    stands alone): (from row, to row, bytes, offsets)."""
    buf, off = _bytes_of(texts)
    n, i = len(texts), 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, side="right")) - 1)
        yield i, j, buf[off[i]: off[j]], off[i: j + 1] - off[i]
        i = j


def planes(a: np.ndarray) -> bytes:
    """Bytes of a fixed-width array, plane by plane (compresses well)."""
    a = np.ascontiguousarray(a)
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes()


def unplanes(b: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(size, -1).T).view(dtype).ravel()


def shingles(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(document index, code) of every window of ``width`` words, documents in
    order; a shorter document with words is one shingle of all its words."""
    at, code = words.windows(width)
    doc = words.doc[at]
    short = np.flatnonzero((words.counts > 0) & (words.counts < width))
    if len(short):
        n = len(words.code)
        pw, inv = _T.powers(0, n + 1)
        p = np.zeros(n + 1, dtype=_U)
        np.cumsum(words.code * pw[:n], out=p[1:])
        a, k = words.first[short], words.counts[short]
        whole = mix(mix((p[a + k] - p[a]) * inv[a]) + k.astype(_U))
        order = np.argsort(np.r_[doc, short], kind="stable")
        doc, code = np.r_[doc, short][order], np.r_[code, whole][order]
    return doc, code
