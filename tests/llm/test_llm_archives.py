"""ZIP directories, WARC records and the round trip through packages."""

import base64
import gzip
import hashlib
import io
import struct
import zipfile
import zlib

import pytest
from pyspark.sql import functions as F

from tributary.llm import warc, zipdir

PAGES = "page_id bigint, url string, html string"


def listed(raw):
    return list(zipdir.members(io.BytesIO(raw), len(raw)))


def zipped(members, comment=b"", method=zipfile.ZIP_STORED):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", method) as z:
        for name, data in members:
            z.writestr(name, data)
        z.comment = comment
    return out.getvalue()


def test_directory_of_a_plain_file():
    raw = zipped([("a.txt", b"one"), ("é/b", b"two" * 1000), ("empty", b"")], comment=b"PK\x05\x06 is no end here")
    source = io.BytesIO(raw)
    found = listed(raw)
    assert [(m.name, m.size, m.stored) for m in found] == [("a.txt", 3, True), ("é/b", 3000, True), ("empty", 0, True)]
    assert [zipdir.read_at(source, zipdir.data_start(source, m), m.size) for m in found] == [b"one", b"two" * 1000, b""]
    assert not listed(zipped([("a", b"x" * 100)], method=zipfile.ZIP_DEFLATED))[0].stored
    assert listed(zipped([])) == []


def test_zip64_by_number_of_members():
    raw = zipped([(f"m{i}", b"%d" % i) for i in range(66000)])
    source = io.BytesIO(raw)
    found = listed(raw)
    assert len(found) == 66000
    last = found[-1]
    assert zipdir.read_at(source, zipdir.data_start(source, last), last.size) == b"65999"


def test_zip64_by_size_and_place():
    """A directory as a file of over 4 GiB has it; only the end of the file is there."""
    far = 5 << 30
    extra = struct.pack("<HHQQQ", 1, 24, far, far, 7 << 30)
    entry = zipdir.ENTRY + struct.pack("<HHHHHHIIIHHHHHII", 45, 45, 0x800, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, 3, len(extra), 0, 0, 0, 0, 0xFFFFFFFF)
    entry += b"big" + extra
    start = 20 << 30
    end64 = zipdir.END64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, 1, 1, len(entry), start)
    locator = zipdir.LOCATOR64 + struct.pack("<IQI", 0, start + len(entry), 1)
    end = zipdir.END + struct.pack("<HHHHIIH", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    tail = entry + end64 + locator + end

    class Far(io.BytesIO):
        def seek(self, at, whence=0):
            if at < start:
                self.gap = start - at
                return super().seek(0)
            self.gap = 0
            return super().seek(at - start)

        def read(self, n=-1):
            blank = min(n, getattr(self, "gap", 0))
            self.gap = getattr(self, "gap", 0) - blank
            return bytes(blank) + super().read(n - blank)

    [member] = zipdir.members(Far(tail), start + len(tail))
    assert (member.name, member.size, member.packed, member.header) == ("big", far, far, 7 << 30)


@pytest.mark.parametrize("raw", [b"", b"PK", b"no zip at all" * 10])
def test_what_is_no_zip_is_refused(raw):
    with pytest.raises(ValueError):
        listed(raw)


def test_cut_off_file_is_refused():
    raw = zipped([("a", b"x" * 100), ("b", b"y")])
    broken = raw.replace(zipdir.ENTRY, b"XX\x01\x02", 1)
    with pytest.raises(ValueError):
        listed(broken)


def wanted(rows):
    first = {}
    for page, _, html in rows:
        body = (html or "").encode()
        if page is not None:
            first[body] = min(page, first.get(body, page))
    for page, url, html in rows:
        body = (html or "").encode()
        head = first.get(body)
        refers = None if head is None or head == page else head
        yield page, url, "response" if refers is None else "revisit", refers, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode()


def test_round_trip(spark):
    rows = [(i, f"http://h/{i}", f"<p>page {i % 40} é</p>" * (i % 7)) for i in range(400)]
    rows += [(1000, None, None), (1001, "http://x/\r\ny z", ""), (None, "u", "<p>alone</p>"), (None, "u", rows[5][2]), (1002, "u", "\r\n\r\nWARC/1.1\r\n"), (1003, "u", "é" * 300000)]
    rows += [(7, "again", rows[7][2])]
    frame = spark.createDataFrame(rows, PAGES).withColumn("payload", F.lit("x")).withColumn("same", F.lit("x"))
    packages = warc.write(frame, package_bytes=4000)
    assert packages.agg(F.sum("records")).first()[0] == len(rows) and packages.count() > 3
    found = warc.read(packages).collect()
    plain = lambda r: (str(r[0]), *map(str, r[2:6]))
    assert sorted(plain((r.page_id, r.url, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest)) for r in found) == sorted(map(plain, wanted(rows)))
    bodies = {r.page_id: bytes(r.payload) for r in found if r.record_type == "response" and r.page_id is not None}
    assert all(bodies[p] == (h or "").encode() for p, _, h in rows if p in bodies)
    urls = {r.page_id: r.url for r in found}
    assert urls[1000] is None and urls[1001] == "http://x/%0D%0Ay%20z"


def test_small_payloads_are_not_revisited_below_the_limit(spark):
    frame = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], PAGES)
    found = {r.page_id: r.refers_to for r in warc.read(warc.write(frame, least_bytes=3)).collect()}
    assert found == {1: None, 2: None, 3: None, 4: 3}


def test_empty_table(spark):
    packages = warc.write(spark.createDataFrame([], PAGES))
    assert packages.count() == 0 and warc.read(packages).count() == 0


def test_package_without_index_is_walked(spark, tmp_path):
    raws = [warc.record(i, "u", b"x" * (i * 1000), None, "2000-01-01T00:00:00Z") for i in range(5)]
    path = str(tmp_path / "p.zip")
    (tmp_path / "p.zip").write_bytes(zipped([("archive/one.warc.gz", b"".join(map(gzip.compress, raws)))]))
    found = warc.read(warc.packages_at(spark, [path])).collect()
    assert sorted((r.page_id, r.payload_bytes) for r in found) == [(i, i * 1000) for i in range(5)]


def test_damage_is_noticed():
    raw = warc.record(1, "u", b"abc", None, "2000-01-01T00:00:00Z")
    with pytest.raises(ValueError, match="digest"):
        warc.parse(raw.replace(b"abc", b"abd"))
    with pytest.raises(ValueError):
        warc.parse(raw[:-6])
    with pytest.raises(ValueError):
        warc.parse(b"junk")
    assert zlib.crc32(raw) == zlib.crc32(warc.record(1, "u", b"abc", None, "2000-01-01T00:00:00Z"))
