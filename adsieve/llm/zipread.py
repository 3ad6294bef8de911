"""Reading stored members of ZIP archives by ranges.

Only the end record, the central directory and the bytes asked for are read.
Archives beyond 4 GB or 65,535 members use the ZIP64 records and extra fields.
"""

from __future__ import annotations

import struct
from collections.abc import Callable
from dataclasses import dataclass

# signatures and sizes of the ZIP format
_END, _END64, _LOCATOR64 = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
_CENTRAL, _LOCAL = b"PK\x01\x02", b"PK\x03\x04"
_FULL16, _FULL32 = 0xFFFF, 0xFFFFFFFF
_END_SIZE, _COMMENT_MAX = 22, 65535

Read = Callable[[int, int], bytes]  # (offset, length) -> bytes


class BadArchive(ValueError):
    """The file is no ZIP archive, is cut off, or contradicts itself."""


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int
    packed: int
    header: int  # offset of its local header


def _directory(read: Read, size: int) -> tuple[int, int, int]:
    """(offset, length, number of members) of the central directory."""
    tail_at = max(0, size - _END_SIZE - _COMMENT_MAX)
    tail = read(tail_at, size - tail_at)
    at = len(tail)
    while True:
        at = tail.rfind(_END, 0, at)
        if at < 0:
            raise BadArchive("no end record")
        # a signature inside the comment is not the record: its length must fit
        if at + _END_SIZE <= len(tail) and at + _END_SIZE + struct.unpack_from("<H", tail, at + 20)[0] == len(tail):
            break
    count, length, offset = struct.unpack_from("<HII", tail, at + 10)
    end = tail_at + at
    if end >= 20 and (_FULL16 == count or _FULL32 in (length, offset)):
        locator = read(end - 20, 20)
        if locator[:4] == _LOCATOR64:
            record = read(struct.unpack_from("<Q", locator, 8)[0], 56)
            if record[:4] != _END64:
                raise BadArchive("no ZIP64 end record where its locator points")
            count, length, offset = struct.unpack_from("<QQQ", record, 32)
    if offset + length > size:
        raise BadArchive("the central directory lies outside the file")
    return offset, length, count


def members(read: Read, size: int) -> list[Member]:
    """The central directory's entries."""
    offset, length, count = _directory(read, size)
    raw, at, out = read(offset, length), 0, []
    for _ in range(count):
        if raw[at: at + 4] != _CENTRAL:
            raise BadArchive("broken central directory")
        flags, method = struct.unpack_from("<HH", raw, at + 8)
        packed, plain = struct.unpack_from("<II", raw, at + 20)
        n_name, n_extra, n_comment = struct.unpack_from("<HHH", raw, at + 28)
        header = struct.unpack_from("<I", raw, at + 42)[0]
        name = raw[at + 46: at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra = raw[at + 46 + n_name: at + 46 + n_name + n_extra]
        at += 46 + n_name + n_extra + n_comment
        k = 0
        while k + 4 <= len(extra):
            kind, n = struct.unpack_from("<HH", extra, k)
            if kind == 1:  # ZIP64: only the fields that are full in the entry, in this order
                wide = iter(struct.unpack_from(f"<{n // 8}Q", extra, k + 4))
                plain = next(wide) if plain == _FULL32 else plain
                packed = next(wide) if packed == _FULL32 else packed
                header = next(wide) if header == _FULL32 else header
            k += 4 + n
        out.append(Member(name, method, plain, packed, header))
    return out


def stored_at(read: Read, member: Member) -> int:
    """Offset of a stored member's first byte."""
    if member.method != 0:
        raise BadArchive(f"{member.name} is compressed, so it cannot be read by ranges")
    local = read(member.header, 30)
    if local[:4] != _LOCAL:
        raise BadArchive(f"no local header of {member.name}")
    n_name, n_extra = struct.unpack_from("<HH", local, 26)
    return member.header + 30 + n_name + n_extra
