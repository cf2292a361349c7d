"""Directory of a ZIP file, read from its end: members are located, not unpacked."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

END, END64, LOCATOR64, ENTRY, LOCAL = (b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04")
END_SIZE, LOCATOR_SIZE, LOCAL_SIZE, ENTRY_SIZE = 22, 20, 30, 46
MOST_COMMENT = 0xFFFF
#: Bytes of the directory read at once.
WINDOW = 1 << 20


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    encrypted: bool
    packed: int
    size: int
    header: int

    @property
    def stored(self) -> bool:
        return self.method == 0 and not self.encrypted


def read_at(source, start: int, length: int) -> bytes:
    """``length`` bytes from ``start``; fewer are an error."""
    source.seek(start)
    parts = []
    while length > 0 and (part := source.read(length)):
        parts.append(part)
        length -= len(part)
    if length > 0:
        raise ValueError("the file ends too early")
    return b"".join(parts)


def directory_place(source, size: int) -> tuple[int, int, int]:
    """Start, length and entries of the central directory."""
    tail_start = max(0, size - END_SIZE - MOST_COMMENT)
    tail = read_at(source, tail_start, size - tail_start)
    at = tail.rfind(END)
    while at >= 0:
        if at + END_SIZE <= len(tail):
            comment = struct.unpack_from("<H", tail, at + 20)[0]
            if at + END_SIZE + comment == len(tail):
                break
        at = tail.rfind(END, 0, at)
    if at < 0:
        raise ValueError("no end of a ZIP directory")
    disk, first_disk, here, entries, length, start, _ = struct.unpack_from("<HHHHIIH", tail, at + 4)
    if 0xFFFF in (disk, first_disk, here, entries) or 0xFFFFFFFF in (length, start):
        locator = tail_start + at - LOCATOR_SIZE
        found = read_at(source, locator, LOCATOR_SIZE) if locator >= 0 else b""
        if found[:4] == LOCATOR64:
            end64 = read_at(source, struct.unpack_from("<Q", found, 8)[0], 56)
            if end64[:4] != END64:
                raise ValueError("no ZIP64 end where its locator points")
            disk, first_disk, here, entries, length, start = struct.unpack_from("<IIQQQQ", end64, 16)
    if disk or first_disk or here != entries:
        raise ValueError("a ZIP file in several parts")
    return start, length, entries


def _wide(extra: bytes, fields: list[int]) -> list[int]:
    """Sizes and place, those of all ones taken from the ZIP64 field."""
    at = 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            values = extra[at + 4 : at + 4 + length]
            out, used = [], 0
            for value in fields:
                if value == 0xFFFFFFFF:
                    value = struct.unpack_from("<Q", values, used)[0]
                    used += 8
                out.append(value)
            return out
        at += 4 + length
    return fields


def members(source, size: int) -> Iterator[Member]:
    """The members of an open, seekable file, as its directory lists them."""
    start, length, entries = directory_place(source, size)
    buffer, at, taken = b"", 0, 0

    def fill(need: int) -> None:
        nonlocal buffer, at, taken
        if len(buffer) - at < need:
            more = min(max(WINDOW, need), length - taken)
            buffer = buffer[at:] + read_at(source, start + taken, more)
            at, taken = 0, taken + more
        if len(buffer) - at < need:
            raise ValueError("a ZIP directory that ends too early")

    for _ in range(entries):
        fill(ENTRY_SIZE)
        if buffer[at : at + 4] != ENTRY:
            raise ValueError("a broken ZIP directory")
        need = ENTRY_SIZE + sum(struct.unpack_from("<HHH", buffer, at + 28))
        fill(need)
        flags, method = struct.unpack_from("<HH", buffer, at + 8)
        packed, plain, name_size, extra_size, _, _, _, _, header = struct.unpack_from("<IIHHHHHII", buffer, at + 20)
        name = buffer[at + ENTRY_SIZE : at + ENTRY_SIZE + name_size]
        extra = buffer[at + ENTRY_SIZE + name_size : at + ENTRY_SIZE + name_size + extra_size]
        plain, packed, header = _wide(extra, [plain, packed, header])
        yield Member(name.decode("utf-8" if flags & 0x800 else "cp437"), method, bool(flags & 1), packed, plain, header)
        at += need


def data_start(source, member: Member) -> int:
    """Where a member's bytes begin, by its local header."""
    header = read_at(source, member.header, LOCAL_SIZE)
    if header[:4] != LOCAL:
        raise ValueError(f"no local header of {member.name}")
    return member.header + LOCAL_SIZE + sum(struct.unpack_from("<HH", header, 26))
