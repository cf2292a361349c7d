"""A large CSV file cut by byte ranges, each in a task of its own.

Whether a newline ends a record depends on all quotes before it. So every range
is first read for what it makes of the cutter's state, whatever the state it
begins in; a scan over these small functions, file by file, gives each range the
state that it does begin in; then each cuts the records that start in it.
"""

from __future__ import annotations

import io
import re
from collections.abc import Iterator
from typing import BinaryIO

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.sources.archive import BLOCK_DDL, FETCH_BYTES, sent_blocks, write_blocks
from tributary.sources.records import (
    AFTER_QUOTE,
    ANY_FIELD,
    BEFORE_QUOTE,
    COMPLETE,
    READ_BYTES,
    RECORD_END,
    cut_any,
    cut_regular,
    joined,
    with_regular_quotes,
)
from tributary.storage import resolve, work_folder

SPLIT_BYTES = 64 << 20

#: In the header line; before a record, a field; in a field without and with
#: quotes; after a quote in a quoted field, which ends it unless another follows.
HEADER, RECORD, FIELD, PLAIN, QUOTED, CLOSED = STATES = range(6)

_MORE = rb"[^,\n]*+(?:," + ANY_FIELD + rb")*+\n"
_IN_QUOTES = rb'[^"]*+(?:""[^"]*+)*+"' + _MORE
#: The rest of a record, by the state it is met in.
REST = {
    HEADER: re.compile(rb"[^\n]*+\n"),
    FIELD: COMPLETE,
    PLAIN: re.compile(_MORE),
    QUOTED: re.compile(_IN_QUOTES),
    CLOSED: re.compile(rb'(?:"' + _IN_QUOTES + rb'|(?!")' + _MORE + rb")"),
}


class Quotes:
    """The quotes of a range, and the state that it ends in."""

    def __init__(self, data: bytes):
        self.data = data
        self.text = np.frombuffer(data, np.uint8)
        self.at = np.flatnonzero(self.text == ord('"'))
        self.listed: list[int] | None = None

    def end_state(self, state: int, start: int = 0) -> int:
        """The state after all bytes from ``start`` on, met in ``state``."""
        data = self.data
        if start >= len(data):
            return state
        if state == HEADER:
            line = data.find(b"\n", start)
            return HEADER if line < 0 else self.end_state(RECORD, line + 1)
        if state == CLOSED and data[start] == ord('"'):
            return self.end_state(QUOTED, start + 1)
        inside, closed = self._run(int(np.searchsorted(self.at, start)), start, state in (RECORD, FIELD), state == QUOTED)
        if inside:
            return QUOTED
        if closed == len(data) - 1:
            return CLOSED
        return {ord("\n"): RECORD, ord(","): FIELD}.get(data[-1], PLAIN)

    def _run(self, first: int, start: int, opens: bool, inside: bool) -> tuple[bool, int]:
        """Whether the end lies inside quotes, and the last quote that closed a field."""
        at = self.at[first:]
        if not len(at):
            return inside, -1
        before = self.text[at - 1]
        if at[0] == start:
            before = before.copy()
            before[0] = ord(",") if opens else ord("x")
        # Regular quotes open and close in turn.
        opening, closing = (slice(1, None, 2), slice(0, None, 2)) if inside else (slice(0, None, 2), slice(1, None, 2))
        follows = np.append(self.text, ord("\n"))[at[closing] + 1]
        if BEFORE_QUOTE[before[opening]].all() and AFTER_QUOTE[follows].all():
            inside = inside != (len(at) % 2 == 1)
            return inside, -1 if inside else int(at[-1])
        opened = ((before == ord(",")) | (before == ord("\n"))).tolist()
        places, closed, i = at.tolist(), -1, 0
        while i < len(places):
            if not inside:
                inside = opened[i]
            elif i + 1 < len(places) and places[i + 1] == places[i] + 1:
                i += 1
            else:
                inside, closed = False, places[i]
            i += 1
        return inside, closed

    def end_states(self) -> list[int]:
        """The end state for every start state."""
        return [self.end_state(state) for state in STATES]


def checked(chunk: bytes) -> bytes:
    if RECORD_END.encode() in chunk:
        raise ValueError("NUL character in the extract")
    return chunk


def range_blocks(source: BinaryIO, state: int, start: int, end: int, read_bytes: int = READ_BYTES) -> Iterator[tuple[int, int, str]]:
    """``(offset, number, records)`` of the records that start in a byte range.

    ``state`` is met at ``start``. The last record is read to its end, wherever
    that lies; the rest of one that started before is left out. Memory is bounded
    by the longest record.
    """
    source.seek(start)
    at, data, wanted = start, b"", read_bytes
    while state != RECORD:
        chunk = checked(source.read(wanted))
        if not chunk:
            return
        data += chunk
        rest = REST[state].match(data)
        if rest:
            at, data, state = start + rest.end(), data[rest.end() :], RECORD
        wanted *= 2

    wanted = read_bytes
    while at < end:
        if at + len(data) < end:
            chunk = checked(source.read(wanted))
            data += chunk
            if not chunk:
                break
        inside = data[: end - at]
        count, block, left = cut_regular(inside) or cut_any(inside)
        if count:
            yield at, count, block.decode("utf-8")
            at += len(inside) - len(left)
            data = data[len(inside) - len(left) :]
        elif at + len(data) >= end:
            break
        # A record longer than what is read is met again from its start.
        wanted = read_bytes if count else wanted * 2
    # What is left starts in the range and may end beyond it.
    while at < end and data:
        whole = COMPLETE.match(data)
        if not whole and (chunk := checked(source.read(wanted))):
            data += chunk
            wanted *= 2
            continue
        count, block, open_quote = cut_any(data[: whole.end()] if whole else data + b"\n")
        if count:
            yield at, count, block.decode("utf-8")
        if open_quote:
            records = with_regular_quotes(open_quote[:-1])
            yield at + len(data) + 1 - len(open_quote), len(records), joined(records).decode("utf-8")
        if not whole:
            return
        at, data = at + whole.end(), data[whole.end() :]


RANGE_DDL = "seq bigint, part bigint, path string, start bigint, stop bigint"
RANGES = [("seq", pa.int64()), ("part", pa.int64()), ("path", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]
FUNCTIONS = pa.schema([*RANGES, ("ends", pa.list_(pa.int32()))])


def byte_ranges(files: DataFrame, split_bytes: int) -> DataFrame:
    """Files (``seq, part, path, length``) as ranges of ``split_bytes``; an empty file has one."""
    starts = F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(split_bytes).cast("bigint"))
    ranges = files.select("seq", "part", "path", "length", F.explode(starts).alias("start"))
    return ranges.withColumn("stop", F.least("length", F.col("start") + split_bytes))


def functions_of_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            system, inner = resolve(row["path"])
            with system.open_input_file(inner) as raw:
                raw.seek(row["start"])
                ends = Quotes(raw.read(row["stop"] - row["start"])).end_states()
            yield pa.RecordBatch.from_pylist([{**row, "ends": ends}], FUNCTIONS)


def scan_states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state that each range begins in; the ranges of a file follow one another."""
    path, state = None, HEADER
    for batch in batches:
        states = []
        for row in batch.select(["path", "ends"]).to_pylist():
            if row["path"] != path:
                path, state = row["path"], HEADER
            states.append(state)
            state = row["ends"][state]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(name) for name, _ in RANGES), pa.array(states, pa.int32())], [*(name for name, _ in RANGES), "state"]
        )


def cut_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            system, inner = resolve(row["path"])
            with system.open_input_file(inner) as raw:
                source = io.BufferedReader(raw, FETCH_BYTES)
                found = range_blocks(source, row["state"], row["start"], row["stop"])
                yield from sent_blocks((row["seq"], row["part"], at, count, body) for at, count, body in found)


def begun_ranges(files: DataFrame, split_bytes: int) -> tuple[DataFrame, int]:
    """All ranges with the state that they begin in, and their number.

    Files of one range begin in their header; the others are read once for their
    quotes, a range per task. What is then sorted by file are six numbers a range.
    """
    ranges = byte_ranges(files, split_bytes)
    single = F.col("length") <= split_bytes
    large = ranges.where(~single).drop("length")
    number, more = ranges.agg(F.count(F.lit(1)), F.count_if(~single)).first()
    begun = ranges.where(single).drop("length").withColumn("state", F.lit(HEADER))
    if more:
        dealt = large.repartitionByRange(more, "path", "start")
        functions = dealt.mapInArrow(functions_of_ranges, f"{RANGE_DDL}, ends array<int>")
        sorted_ranges = functions.repartition("path").sortWithinPartitions("path", "start")
        begun = begun.unionByName(sorted_ranges.mapInArrow(scan_states, f"{RANGE_DDL}, state int"))
    return begun, number


def unpack_ranges(files: DataFrame, split_bytes: int = SPLIT_BYTES) -> str:
    """CSV files (``seq, part, path, length``) cut into a stored block table, a range per task.

    ``first_row`` of a block is its place in the file's bytes, so rows are in file
    order, with gaps.
    """
    begun, number = begun_ranges(files, split_bytes)
    out = work_folder(files.sparkSession, "records")
    spread = begun.repartitionByRange(max(1, number), "path", "start")
    write_blocks(spread.mapInArrow(cut_ranges, BLOCK_DDL), out)
    return out
