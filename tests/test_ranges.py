"""Files cut by byte ranges against the cutter that reads them as a stream."""

import csv
import io
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.helpers import plan
from tributary.sources import ranges
from tributary.sources.archive import file_paths, read_blocks, records
from tributary.sources.extract import scan_csv
from tributary.sources.ranges import HEADER, STATES, Quotes, range_blocks
from tributary.sources.records import record_blocks

PIECES = ["a", "é", " ", '"', '""', ",", '",', "\n", "\r\n", "\r", "\\", '\n"', 'x,"y\n', '"a"b', '5" p,']


def fields(records):
    """The records' fields; how they are quoted depends on where the reads ended."""
    return [(list(csv.reader(io.StringIO(r, newline="\n"))) or [[]])[0] for r in records]


def streamed(data):
    return fields(r for _, body in record_blocks(io.BytesIO(data)) for r in body.split("\0")[:-1])


def by_ranges(data, split, read_bytes):
    """The records range by range, each in the state that the ranges before lead to."""
    out, state, last = [], HEADER, -1
    for start in range(0, max(1, len(data)), split):
        piece = data[start : start + split]
        for at, count, body in range_blocks(io.BytesIO(data), state, start, start + len(piece), read_bytes):
            assert at > last and body.count("\0") == count
            last = at + count - 1
            out += body.split("\0")[:-1]
        state = Quotes(piece).end_state(state)
    return fields(out)


def outcome(cut):
    try:
        return cut()
    except csv.Error:
        return "error"


@settings(max_examples=1500, deadline=None)
@given(
    st.lists(st.sampled_from(PIECES), max_size=25).map("".join),
    st.sampled_from(["h\n", 'a,"b\n', "", "long header line\n"]),
    st.sampled_from([1, 2, 3, 7, 20, 1000]),
    st.sampled_from([1, 3, 64]),
)
def test_ranges_give_the_stream_s_records(text, header, split, read_bytes):
    data = (header + text).encode()
    assert outcome(lambda: by_ranges(data, split, read_bytes)) == outcome(lambda: streamed(data))


def plain_end(data, state):
    """The cutter's states byte by byte."""
    quote, comma, newline = b'",\n'
    for byte in data:
        if state == ranges.HEADER:
            state = ranges.RECORD if byte == newline else state
        elif state == ranges.QUOTED:
            state = ranges.CLOSED if byte == quote else state
        elif byte == quote and state in (ranges.RECORD, ranges.FIELD, ranges.CLOSED):
            state = ranges.QUOTED
        else:
            state = {comma: ranges.FIELD, newline: ranges.RECORD}.get(byte, ranges.PLAIN)
    return state


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=20).map("".join))
def test_end_states_are_those_of_the_machine(text):
    data = text.encode()
    assert Quotes(data).end_states() == [plain_end(data, state) for state in STATES]


def big_file(path, rows, stray, seed=3):
    """Quoted newlines, doubled quotes, a record longer than several ranges, and stray quotes."""
    rnd = random.Random(seed)
    with open(path, "w", newline="") as out:
        out.write('id,"head\n')
        for i in range(rows):
            text = rnd.choice(["plain", '"l1\nl2, ""q"" ""\n"', '"\r\n\r\n,,"', '""', "", '"x""y"', "é" * rnd.randrange(30)])
            if stray:
                text = rnd.choice([text, '5" pipe', '"a"b"c', '"shut" "', 'm"\n7,"\n"'])
            out.write(f"{i},{text},{'\"' + 'long\n' * 4000 + '\"' if i == rows // 2 else 'z'}\n")


THREE = T.StructType([T.StructField(n, T.StringType()) for n in "abc"])


@pytest.mark.parametrize("stray", [False, True])
def test_a_file_by_many_tasks_is_the_file_by_one(spark, tmp_path, stray):
    path = f"{tmp_path}/big.csv"
    big_file(path, 4000, stray)
    files = file_paths(spark, path).select(F.lit(0).cast("bigint").alias("seq"), F.lit(0).cast("bigint").alias("part"), "path", "length")
    wanted = streamed(open(path, "rb").read())
    for split in (1000, 1 << 16, 1 << 30):
        out = ranges.unpack_ranges(files, split)
        found = [r.record for r in records(read_blocks(spark, out)).orderBy("row").collect()]
        assert fields(found) == wanted
    begun, number = ranges.begun_ranges(files, 1 << 14)
    size = files.first()["length"]
    assert number == begun.count() == -(-size // (1 << 14))
    states = {r.state for r in begun.collect()}
    assert states >= {HEADER, ranges.QUOTED} and len(states) >= 3


def test_ranges_are_tasks(spark, tmp_path):
    big_file(f"{tmp_path}/a.csv", 1000, False)
    (tmp_path / "b.csv").write_text("only,a,header\n")
    (tmp_path / "c.csv").write_text("")
    files = file_paths(spark, str(tmp_path)).select(F.lit(0).cast("bigint").alias("seq"), F.lit(0).cast("bigint").alias("part"), "path", "length")
    begun, number = ranges.begun_ranges(files, 4096)
    spread = begun.repartitionByRange(number, "path", "start")
    per_task = [r[0] for r in spread.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert len(per_task) == number and set(per_task) == {1}
    assert "MapInArrow" in plan(begun) and "BroadcastExchange" not in plan(begun)
    rows = scan_csv(spark, str(tmp_path), THREE, 4096)
    assert rows.count() == 1000


def test_bad_bytes_fail_in_any_range(spark, tmp_path):
    for bad, about in ((b"\0", "NUL"), (b"\xff", "utf-8")):
        (tmp_path / "bad.csv").write_bytes(b"h\n" + b"1,a,b\n" * 500 + b"2," + bad + b",c\n" + b"3,a,b\n" * 500)
        with pytest.raises(Exception, match=about):
            scan_csv(spark, f"{tmp_path}/bad.csv", THREE, 256).count()
