"""WARC records in ZIP packages: written, located by directory and index, read by range."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zipfile
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm import zipdir
from tributary.llm.common import stored
from tributary.storage import resolve, work_folder

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.txt"
#: A package is closed once it holds so many bytes.
PACKAGE_BYTES = 64 << 20
#: Records this near to each other are read together.
READ_BYTES = 4 << 20
#: Bytes of records that a task reads.
TASK_BYTES = 8 << 20
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CONTROL = re.compile(r"[\x00-\x20\x7f]")
RECORD = "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, payload binary"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _number(name: str | None) -> int | None:
    digits = name[len("<urn:page:") : -1] if name else ""
    return int(digits) if digits else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One record; a revisit keeps the HTTP headers and not the payload."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_name(page_id)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url))
    if revisit:
        lines += [f"WARC-Refers-To: {_name(refers_to)}", f"WARC-Profile: {REVISIT}"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def _headers(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:]) if k}


def parse(raw: bytes) -> dict:
    """The fields of one record; a payload that is not what its digest says is an error."""
    end = raw.find(b"\r\n\r\n")
    if not raw.startswith(b"WARC/") or end < 0:
        raise ValueError("no WARC record")
    head = _headers(raw[:end])
    block = raw[end + 4 : end + 4 + int(head["content-length"])]
    if len(block) != int(head["content-length"]):
        raise ValueError("a WARC record that ends too early")
    http_end = block.find(b"\r\n\r\n")
    http, payload = _headers(block[:http_end]), block[http_end + 4 :]
    said = head.get("warc-payload-digest", "").removeprefix("sha1:")
    if head["warc-type"] == "response":
        if digest(payload) != said:
            raise ValueError(f"payload of {head['warc-record-id']} does not match its digest")
        size = len(payload)
    else:
        size, payload = int(http["content-length"]), None
    return {
        "page_id": _number(head["warc-record-id"]),
        "url": head.get("warc-target-uri"),
        "record_type": head["warc-type"],
        "refers_to": _number(head.get("warc-refers-to")),
        "payload_bytes": size,
        "payload_digest": said,
        "payload": payload,
    }


class Packages:
    """ZIP packages of one task; each holds stored records and their index."""

    def __init__(self, folder: str, most: int):
        self.system, self.folder = resolve(folder)
        self.most, self.sink = most, None
        self.done: list[tuple[str, int]] = []

    def add(self, raw: bytes) -> None:
        if self.sink is None:
            self.system.create_dir(self.folder, recursive=True)
            self.path = f"pages-{uuid.uuid4().hex}.zip"
            self.sink = self.system.open_output_stream(f"{self.folder}/{self.path}")
            self.zip = zipfile.ZipFile(self.sink, "w", zipfile.ZIP_STORED)
            self.member = self.zip.open(ARCHIVE, "w", force_zip64=True)
            self.index, self.at = [], 0
        packer = zlib.compressobj(1, zlib.DEFLATED, 31)
        packed = packer.compress(raw) + packer.flush()
        self.member.write(packed)
        self.index.append(f"{self.at} {len(packed)} {ARCHIVE}\n")
        self.at += len(packed)
        if self.at >= self.most:
            self.close()

    def close(self) -> None:
        if self.sink is not None:
            self.member.close()
            self.zip.writestr(INDEX, "".join(self.index))
            self.zip.close()
            self.sink.close()
            self.done.append((self.path, len(self.index)))
            self.sink = None


def revisits(pages: DataFrame, least_bytes: int) -> DataFrame:
    """``page_id, url, payload, refers_to`` of ``pages`` (``page_id, url, html``).

    Of rows with equal payloads of at least ``least_bytes`` bytes, the others
    refer to the smallest id. Payloads are equal by SHA-256.
    """
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string").cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("same", F.sha2("payload", 256))
    many = rows.where(F.length("payload") >= least_bytes).groupBy("same").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    many = stored(many.where("n > 1 AND first IS NOT NULL").select("same", "first"), "repeated")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return rows.join(many, "same", "left").select("page_id", "url", "payload", refers.alias("refers_to"))


def write(pages: DataFrame, least_bytes: int = 0, date: str = "2000-01-01T00:00:00Z", package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Packages of one record per row of ``pages``; ``(package, records)`` of each.

    Rows that repeat the smallest id of their payload are responses like it; if
    no row of a payload has an id, all are. A null html has an empty payload, a
    null url no target. Other columns are not read. An empty table writes no
    package. What a failed task left behind is in no list and is never read.
    """
    folder = work_folder(pages.sparkSession, "packages")

    def written(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Packages(folder, package_bytes)
        for batch in batches:
            for row in zip(*batch.columns, strict=True):
                page_id, url, payload, refers_to = (v.as_py() for v in row)
                out.add(record(page_id, url, payload, refers_to, date))
        out.close()
        paths = pa.array([f"{folder}/{path}" for path, _ in out.done], pa.string())
        yield pa.RecordBatch.from_arrays([paths, pa.array([n for _, n in out.done], pa.int64())], ["package", "records"])

    return stored(revisits(pages, least_bytes).mapInArrow(written, "package string, records bigint"), "written")


def locate(packages: DataFrame) -> DataFrame:
    """Place of every record: ``package, start, length`` in the file's own bytes.

    By the packages' directories and indexes; only these are read. A package
    without an index has its archive members walked instead.
    """

    def located(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("package").to_pylist():
                system, inner = resolve(path)
                with system.open_input_file(inner) as source:
                    places = list(_places(source, source.size()))
                starts, lengths = zip(*places, strict=True) if places else ((), ())
                columns = [pa.array([path] * len(places), pa.string()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["package", "start", "length"])

    return packages.select("package").mapInArrow(located, "package string, start bigint, length bigint")


def _places(source, size: int) -> Iterator[tuple[int, int]]:
    held = {m.name: m for m in zipdir.members(source, size)}
    archives = {n: m for n, m in held.items() if n.startswith("archive/") and n.endswith(".warc.gz")}
    for member in archives.values():
        if not member.stored:
            raise ValueError(f"{member.name} is packed; only stored archives can be read by range")
    starts = {n: zipdir.data_start(source, m) for n, m in archives.items()}
    indexes = [m for n, m in held.items() if n.startswith("indexes/") and m.stored]
    for member in indexes:
        raw = zipdir.read_at(source, zipdir.data_start(source, member), member.size)
        for line in raw.decode().splitlines():
            at, length, name = line.split(" ", 2)
            if int(at) + int(length) > archives[name].size:
                raise ValueError(f"the index points behind {name}")
            yield starts[name] + int(at), int(length)
    if not indexes:
        for name, member in archives.items():
            yield from _walk(source, starts[name], member.size)


def _walk(source, start: int, size: int) -> Iterator[tuple[int, int]]:
    """Places of the compressed records of a member, one after another."""
    at, begun, opened, buffer = start, start, zlib.decompressobj(31), b""
    while at < start + size or buffer:
        if not buffer:
            buffer = zipdir.read_at(source, at, min(1 << 20, start + size - at))
            at += len(buffer)
        opened.decompress(buffer)
        buffer = opened.unused_data
        if opened.eof:
            end = at - len(buffer)
            yield begun, end - begun
            begun, opened = end, zlib.decompressobj(31)


def read(packages: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of ``packages``, read by range and checked against their digests.

    Records near each other go to one task and are read together. With
    ``payloads`` false the payload column is null.
    """
    places = stored(locate(packages), "places")
    # The rows are few bytes; what they stand for decides on the number of tasks.
    tasks = -(-(places.agg(F.sum("length")).first()[0] or 0) // TASK_BYTES) or 1
    places = places.withColumn("near", F.floor(F.col("start") / READ_BYTES))
    places = places.repartition(tasks, "package", "near").sortWithinPartitions("package", "start")
    kinds = [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
    kinds += [("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())]

    def fetched(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column("package").to_pylist(), batch.column("start").to_pylist(), batch.column("length").to_pylist(), strict=True)
            for path, runs in _runs(rows):
                system, inner = resolve(path)
                with system.open_input_file(inner) as source:
                    for run in runs:
                        yield _records(source, run)

    def _records(source, run: list[tuple[int, int]]) -> pa.RecordBatch:
        first, last = run[0][0], max(s + n for s, n in run)
        raw = zipdir.read_at(source, first, last - first)
        found = [parse(zlib.decompress(raw[s - first : s - first + n], 31)) for s, n in run]
        if not payloads:
            for row in found:
                row["payload"] = None
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in found], kind) for k, kind in kinds], [k for k, _ in kinds])

    return places.select("package", "start", "length").mapInArrow(fetched, RECORD)


def _runs(rows: Iterable[tuple[str, int, int]]) -> Iterator[tuple[str, list[list[tuple[int, int]]]]]:
    """Rows of one package after another, cut into runs of about ``READ_BYTES``."""
    path, runs, begun = None, [], 0
    for package, start, length in rows:
        if package != path:
            if runs:
                yield path, runs
            path, runs = package, []
        if not runs or start + length - begun > READ_BYTES:
            runs.append([])
            begun = start
        runs[-1].append((start, length))
    if runs:
        yield path, runs


def packages_at(spark: SparkSession, paths: list[str]) -> DataFrame:
    """A table of packages by their paths, for ``read``."""
    return spark.createDataFrame([(p,) for p in paths], "package string")

