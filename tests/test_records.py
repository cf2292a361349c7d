import csv
import io

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tributary.sources.records import cut_any, cut_regular, record_blocks

PIECES = ["a", "é", " ", '"', '""', ",", '",', "\n", "\r\n", "\r", "\\", '\n"', "x,y"]


def records_of(text, read_bytes):
    out = []
    for count, body in record_blocks(io.BytesIO(("header\n" + text).encode()), read_bytes):
        found = body.split("\0")
        assert found.pop() == "" and len(found) == count
        out += found
    return out


def fields(text):
    return list(csv.reader(io.StringIO(text, newline="\n")))


def expected(text):
    try:
        return fields(text)
    except csv.Error:
        return "error"


def found(text, read_bytes):
    try:
        return [(fields(r) or [[]])[0] for r in records_of(text, read_bytes)]
    except csv.Error:
        return "error"


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=25).map("".join), st.sampled_from([1, 3, 16, 4096]))
def test_records_are_those_of_a_csv_reader(text, read_bytes):
    assert found(text, read_bytes) == expected(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.text(alphabet='a",\n\r ', max_size=6), min_size=2, max_size=4), max_size=8))
def test_both_cuts_agree_on_written_csv(rows):
    text = io.StringIO()
    csv.writer(text).writerows(rows)
    data = text.getvalue().encode()
    assert cut_regular(data) == cut_any(data)
    assert found(text.getvalue(), 7) == rows


def test_block_size_does_not_change_records():
    text = "".join(f'{i},"line {i}\nsecond, ""line""\r\n",end\r\n' for i in range(500))
    whole = records_of(text, 1 << 20)
    assert len(whole) == 500
    for size in (1, 10, 100, 1000):
        assert records_of(text, size) == whole


def test_header_is_the_first_line_whatever_it_holds():
    assert records_of("1,2", 4096) == ["1,2"]
    body = io.BytesIO(b'a,"b\n1,2\n')
    assert list(record_blocks(body)) == [(1, "1,2\0")]


def test_empty_inputs():
    assert list(record_blocks(io.BytesIO(b""))) == []
    assert records_of("", 4096) == []
    assert records_of("\n", 4096) == [""]


def test_last_record_may_be_unended():
    assert records_of('1,"x\ny"', 4) == ['1,"x\ny"']
    assert fields(records_of('1,"open', 4)[0]) == [["1", "open"]]


def test_stray_quotes_are_quoted_anew():
    assert records_of('5" pipe,"a"b\n1,2\n', 4096) == ['"5"" pipe",ab', "1,2"]


def test_bad_bytes_fail():
    with pytest.raises(UnicodeDecodeError):
        list(record_blocks(io.BytesIO(b"h\n\xff\xfe,1\n")))
    with pytest.raises(ValueError, match="NUL"):
        list(record_blocks(io.BytesIO(b"h\na\x00b,1\n")))
    with pytest.raises(csv.Error):
        list(record_blocks(io.BytesIO(b"h\na\rb,1\n")))


def test_record_longer_than_many_reads():
    text = "1," + '"' + "x\n" * 50_000 + '"\n2,y\n'
    found = records_of(text, 64)
    assert [len(r) for r in found] == [100_004, 3]


def test_fields_have_no_limit_whatever_their_quotes():
    long = "y" * 200_000
    for text in (f"1,{long}", f"1,{long}\n", f'5" pipe,{long}', f'5" pipe,{long}\n'):
        assert fields(records_of(text, 4096)[0])[0][1] == long
