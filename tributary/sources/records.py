"""Cutting a CSV byte stream into whole records.

A helper for the unpack tasks. A newline ends a record unless it lies inside a
quoted field, and a quote opens a field only as the field's first character.
Records leave in blocks of text, each record closed by NUL: a text column of
the target tables cannot hold NUL, so a NUL in the input is an error.
"""

from __future__ import annotations

import csv
import io
import re
import sys
from collections.abc import Iterator
from typing import BinaryIO

import numpy as np

READ_BYTES = 1 << 16
RECORD_END = "\x00"

_QUOTED = rb'"[^"]*+(?:""[^"]*+)*+"'
_REGULAR_FIELD = rb"(?:" + _QUOTED + rb'|[^",\r\n]*+)'
ANY_FIELD = rb"(?:" + _QUOTED + rb'[^,\n]*+|[^",\n][^,\n]*+|)'


def byte_set(members: bytes) -> np.ndarray:
    """Truth per byte value."""
    return np.isin(np.arange(256), list(members))


BEFORE_QUOTE = byte_set(b',\n"')
AFTER_QUOTE = byte_set(b',\r\n"')
REGULAR = re.compile(_REGULAR_FIELD + rb"(?:," + _REGULAR_FIELD + rb")*+\r?\n")
COMPLETE = re.compile(ANY_FIELD + rb"(?:," + ANY_FIELD + rb")*+\n")


def with_regular_quotes(record: bytes) -> list[bytes]:
    """A record with stray quotes (or a quote left open at the end), quoted anew."""
    # Python's reader would otherwise refuse fields of over 131,072 characters.
    csv.field_size_limit(sys.maxsize)
    rows = list(csv.reader(io.StringIO(record.decode("utf-8"), newline="\n")))
    out = []
    for row in rows:
        text = io.StringIO()
        csv.writer(text, lineterminator="").writerow(row)
        out.append(text.getvalue().encode("utf-8"))
    return out


def cut_regular(data: bytes) -> tuple[int, bytes, bytes] | None:
    """Number of whole records, their block and what is left of ``data``.

    None if quotes or carriage returns stand where a plain CSV writer puts
    none; then the quotes seen so far do not tell whether a field is open.
    """
    last = data.rfind(b"\n") + 1
    lines = data[:last]
    if b'"' not in lines:
        lines = lines.replace(b"\r\n", b"\n")
        if b"\r" in lines:
            return None
        return lines.count(b"\n"), lines.replace(b"\n", b"\x00"), data[last:]
    text = np.frombuffer(lines, dtype=np.uint8)
    # Regular quotes open and close in turn: after an even number of them a
    # byte lies outside quoted fields.
    quotes, newlines = np.flatnonzero(text == ord('"')), np.flatnonzero(text == ord("\n"))
    ends = newlines[outside(newlines, quotes)]
    if not len(ends):
        return 0, b"", data
    size = int(ends[-1]) + 1
    quotes = quotes[quotes < size]
    opening, closing = quotes[0::2], quotes[1::2]
    before = text[opening - 1]
    before[opening == 0] = ord(",")
    returns = np.flatnonzero(text[:size] == ord("\r"))
    returns = returns[outside(returns, quotes)]
    if not (
        BEFORE_QUOTE[before].all()
        and AFTER_QUOTE[text[closing + 1]].all()
        and (text[returns + 1] == ord("\n")).all()
    ):
        return None
    block = text[:size].copy()
    block[ends] = 0
    return len(ends), block.tobytes().replace(b"\r\x00", b"\x00"), data[size:]


def outside(places: np.ndarray, quotes: np.ndarray) -> np.ndarray:
    """Whether each place has an even number of quotes before it."""
    return np.searchsorted(quotes, places) % 2 == 0


def cut_any(data: bytes) -> tuple[int, bytes, bytes]:
    """The same for any input, one record after the other."""
    records: list[bytes] = []
    at = 0
    while True:
        match = REGULAR.match(data, at)
        if match:
            records.append(data[at : match.end()].rstrip(b"\r\n"))
        else:
            match = COMPLETE.match(data, at)
            if not match:
                return len(records), joined(records), data[at:]
            records.extend(with_regular_quotes(match.group()))
        at = match.end()


def joined(records: list[bytes]) -> bytes:
    return b"".join(record + b"\x00" for record in records)


def record_blocks(source: BinaryIO, read_bytes: int = READ_BYTES) -> Iterator[tuple[int, str]]:
    """``(number of records, records)`` blocks of a CSV stream.

    The first line is the header and is left out, whatever it holds. Bytes
    that are not UTF-8 are an error. The last record needs no newline. Memory is
    bounded by the longest record.
    """
    source.readline()
    left, wanted = b"", read_bytes
    while chunk := source.read(wanted):
        if RECORD_END.encode() in chunk:
            raise ValueError("NUL character in the extract")
        data = left + chunk
        count, block, left = cut_regular(data) or cut_any(data)
        if count:
            yield count, block.decode("utf-8")
        # A record longer than the buffer is met again from its start: double
        # the read each time so that the work stays linear.
        wanted = read_bytes if count else wanted * 2
    if left:
        count, block, open_quote = cut_regular(left + b"\n") or cut_any(left + b"\n")
        if count:
            yield count, block.decode("utf-8")
        if open_quote:
            records = with_regular_quotes(open_quote[:-1])
            yield len(records), joined(records).decode("utf-8")
