"""Batch encoders over the tokenizers library, one per task process.

A tokenizer that drops white space encodes a text as the concatenation of its
words' encodings, so `WordEncoder` encodes a word once and remembers it (a
bounded memo). `ByteEncoder` is for byte-level tokenizers that keep it.
"""

from __future__ import annotations

import functools
import os
import re
import string
from array import array

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

MEMO_CHUNKS = 200_000  # a full memo keeps what it has: common chunks come early
MEMO_SPANS = 20_000
MEMO_BYTES = 64  # longer chunks are not remembered
_MARKS = string.punctuation.encode()


def _byte_characters() -> dict[int, int]:
    """The character that stands for each byte in a byte-level vocabulary:
    visible ones for themselves, the others counted on from 256."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: b for b in visible} | {b: 256 + i for i, b in enumerate(hidden)}


_CHARACTERS = _byte_characters()


@functools.lru_cache(maxsize=4)
def load(path: str):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


class _Memo(dict):
    """Ids by word, for a lower-casing tokenizer. A run of Latin letters is one
    pre-token, so it goes to the tokenizer's model directly. Marks after
    letters start a pre-token of their own, so ``word,`` is ``word`` and ``,``.
    All else the library splits."""

    def __init__(self, encode, model):
        super().__init__()
        self._encode, self._model = encode, model

    def __missing__(self, chunk: bytes) -> bytes:
        text = chunk.decode()
        if text.isalpha():
            text = text.lower()
        if text.isalpha() and max(text) < "\u0250":
            run = text.encode().decode("latin-1").translate(_CHARACTERS)
            ids = array("I", [t.id for t in self._model.tokenize(run)]).tobytes()
        else:
            head = chunk.rstrip(_MARKS)
            if len(head) < len(chunk) and head.isalpha():
                ids = self[head] + self[chunk[len(head):]]
            else:
                ids = array("I", self._encode(chunk.decode())).tobytes()
        if len(self) < MEMO_CHUNKS and len(chunk) <= MEMO_BYTES:
            self[chunk] = ids
        return ids


class WordEncoder:
    """For lower-casing tokenizers that drop white space: chunks are words between
    ASCII white space (`bytes.split` splits at exactly ``[\\x20\\x09-\\x0D]``)."""

    def __init__(self, path: str):
        self._tok = load(path)
        plain = lambda s: self._tok.encode(s, add_special_tokens=False).ids
        if plain(" Ab\n c ") != plain("ab") + plain("c"):
            raise ValueError(f"{path} does not drop white space and case")
        self._memo = _Memo(plain, self._tok.model)
        self._spans: dict[str, tuple] = {}

    def ids(self, text: str) -> bytes:
        """Little-endian 32-bit ids of a text."""
        return b"".join(map(self._memo.__getitem__, text.encode().split()))

    def with_offsets(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, first character, end) of every token."""
        ids, starts, ends = [], [], []
        for m in re.finditer(r"[^\x20\x09-\x0D]+", text):
            got = self._spans.get(m[0])
            if got is None:
                e = self._tok.encode(m[0], add_special_tokens=False)
                got = e.ids, [a for a, _ in e.offsets], [b for _, b in e.offsets]
                if len(m[0]) <= MEMO_BYTES and len(self._spans) < MEMO_SPANS:
                    self._spans[m[0]] = got
            at = m.start()
            ids += got[0]
            starts += [a + at for a in got[1]]
            ends += [b + at for b in got[2]]
        return np.array(ids, np.int32), np.array(starts, np.int64), np.array(ends, np.int64)


    def with_edges(self, text: str, edge: int = 1024) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Like `with_offsets`, but tokens far from both ends carry the empty
        span at the head's end: only the ends are needed to join pieces."""
        head = re.compile(r"[\x20\x09-\x0D]").search(text, edge)
        tail = max(text.rfind(c, 0, max(0, len(text) - edge)) for c in " \t\n\x0b\x0c\r")
        if head is None or tail <= head.start():
            return self.with_offsets(text)
        a, b = head.start(), tail
        left, right = self.with_offsets(text[:a]), self.with_offsets(text[b:])
        mid = np.frombuffer(self.ids(text[a:b]), "<u4").astype(np.int32)
        at = np.full(len(mid), a, np.int64)
        return (np.concatenate([left[0], mid, right[0]]), np.concatenate([left[1], at, right[1] + b]),
                np.concatenate([left[2], at, right[2] + b]))


class ByteEncoder:
    """For byte-level tokenizers with the usual splitting pattern and no
    normalizer. Latin text is encoded by tiktoken over the file's own
    vocabulary (ids are merge ranks there, so the ids are the same and come
    several times faster); the rest by the tokenizers library."""

    # as the library's byte-level splitter
    PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

    def __init__(self, path: str):
        import tiktoken

        self._tok = load(path)
        added = {t.content: i for i, t in self._tok.get_added_tokens_decoder().items()}
        byte = {chr(c): b for b, c in _CHARACTERS.items()}
        ranks = {bytes(byte[c] for c in t): i for t, i in self._tok.get_vocab(with_added_tokens=False).items() if t not in added}
        self._fast = tiktoken.Encoding(path, pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._added = list(added)
        # a file with other rules (a normalizer, another pattern) is left to its library
        probe = "It's A probe,  of\t\nTEXT 12,345 - caf\u00e9!! \u00a0x "
        self._same = self._fast.encode_ordinary(probe) == self._tok.encode(probe, add_special_tokens=False).ids

    def ids(self, text: str) -> bytes:
        """Little-endian 32-bit ids of a text."""
        if self._same and (text.isascii() or max(text) < "\u0250") and not any(t in text for t in self._added):
            return array("I", self._fast.encode_ordinary(text)).tobytes()
        return array("I", self._tok.encode(text, add_special_tokens=False).ids).tobytes()


@functools.lru_cache(maxsize=4)
def encoder(kind: type, path: str):
    """The process's encoder; its memo lives as long as the worker."""
    return kind(path)
