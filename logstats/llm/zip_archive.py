"""Reading ZIP archives by ranges: directory, stored members, nothing unpacked to disk."""

from __future__ import annotations

import struct
from dataclasses import dataclass
from typing import Protocol

# Fixed values of the format: signatures, and the marks that refer to the ZIP64 fields.
END, END64, LOCATOR64, ENTRY, LOCAL = b"PK\5\6", b"PK\6\6", b"PK\6\7", b"PK\1\2", b"PK\3\4"
NONE16, NONE32 = 0xFFFF, 0xFFFFFFFF
STORED = 0


class RandomAccess(Protocol):
    def size(self) -> int: ...

    def read_at(self, nbytes: int, offset: int) -> bytes: ...


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    crc32: int
    stored_size: int
    size: int
    header_at: int


def _directory(source: RandomAccess) -> tuple[int, int, int]:
    """Number of entries, size and place of the central directory."""
    total = source.size()
    length = min(total, 22 + NONE16)
    tail = source.read_at(length, total - length)
    at = tail.rfind(END)
    while at >= 0 and (
        len(tail) - at < 22 or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)
    ):
        at = tail.rfind(END, 0, at)
    if at < 0:
        raise ValueError("not a ZIP archive: no end of central directory")
    entries, size, place = struct.unpack_from("<HII", tail, at + 10)
    end_at = total - length + at
    if end_at >= 20:
        locator = source.read_at(20, end_at - 20)
        if locator[:4] == LOCATOR64 and (entries == NONE16 or size == NONE32 or place == NONE32):
            record = source.read_at(56, struct.unpack_from("<Q", locator, 8)[0])
            if record[:4] != END64:
                raise ValueError("damaged ZIP64 directory record")
            entries, size, place = struct.unpack_from("<QQQ", record, 32)
    return entries, size, place


def _long_fields(extra: bytes, fields: list[int]) -> list[int]:
    """Size, stored size and place with the marked ones taken from the ZIP64 field."""
    at = 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            values = extra[at + 4 : at + 4 + length]
            for i, value in enumerate(fields):
                if value == NONE32:
                    fields[i] = struct.unpack_from("<Q", values)[0]
                    values = values[8:]
        at += 4 + length
    return fields


def read_members(source: RandomAccess) -> dict[str, Member]:
    entries, size, place = _directory(source)
    data, at, members = source.read_at(size, place), 0, {}
    for _ in range(entries):
        if data[at : at + 4] != ENTRY:
            raise ValueError("damaged central directory")
        flags, method = struct.unpack_from("<HH", data, at + 8)
        crc, stored, plain, name_len, extra_len, note_len = struct.unpack_from("<IIIHHH", data, at + 16)
        header_at = struct.unpack_from("<I", data, at + 42)[0]
        name = data[at + 46 : at + 46 + name_len].decode("utf-8" if flags & 0x800 else "cp437")
        extra = data[at + 46 + name_len : at + 46 + name_len + extra_len]
        plain, stored, header_at = _long_fields(extra, [plain, stored, header_at])
        members[name] = Member(name, method, crc, stored, plain, header_at)
        at += 46 + name_len + extra_len + note_len
    return members


def stored_range(source: RandomAccess, member: Member) -> tuple[int, int]:
    """Place and length of a stored member's bytes in the archive."""
    if member.method != STORED:
        raise ValueError(f"{member.name} is compressed and has no range of its own")
    header = source.read_at(30, member.header_at)
    if header[:4] != LOCAL:
        raise ValueError(f"damaged header of {member.name}")
    name_len, extra_len = struct.unpack_from("<HH", header, 26)
    return member.header_at + 30 + name_len + extra_len, member.size
