"""Zip archives to a stored table of raw records."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.sources.records import RECORD_END, record_blocks
from tributary.storage import resolve, work_folder

ARCHIVE_COLUMNS = ["seq", "part", "path", "length"]
BLOCK_DDL = "seq bigint, part bigint, first_row bigint, row_count bigint, body string"
BLOCK_ARROW = pa.schema(
    [
        ("seq", pa.int64()),
        ("part", pa.int64()),
        ("first_row", pa.int64()),
        ("row_count", pa.int64()),
        ("body", pa.string()),
    ]
)
BATCH_CHARACTERS = 4 << 20
BLOCKS_PER_FILE = 16384
# Text is dear to parse for its size: small row groups let the readers share
# even one archive's records.
ROW_GROUP_BYTES = 8 << 20
# An archive of up to so many bytes may be parsed by the task that inflates it.
STREAMED_BYTES = 256 << 20

# The zip reader asks for small pieces; a remote file is fetched in large ones.
FETCH_BYTES = 4 << 20

# The binaryFile source lists files with Spark's own file systems; its content
# column is never read here.
FILE_DDL = "path string, modificationTime timestamp, length bigint, content binary"


def file_paths(spark: SparkSession, location: str) -> DataFrame:
    """``(path, length)`` of a file or of all files below a folder."""
    files = spark.read.format("binaryFile").schema(FILE_DDL).option("recursiveFileLookup", "true")
    return files.load(location).select("path", "length")


def archive_paths(spark: SparkSession, location: str) -> DataFrame:
    """``(path, length)`` of a zip file or of all files below a folder.

    A file of another kind is an error: an extract that is partly misnamed would
    otherwise load in part.
    """
    other = F.raise_error(F.concat(F.lit("not a zip archive: "), F.col("path"))).cast("boolean")
    return file_paths(spark, location).where(F.when(F.lower("path").endswith(".zip"), True).otherwise(other))


def archive_blocks(path: str) -> Iterator[tuple[int, str]]:
    """Record blocks of the only entry of a zip file, read as a stream."""
    system, inner = resolve(path)
    with system.open_input_file(inner) as raw, zipfile.ZipFile(io.BufferedReader(raw, FETCH_BYTES)) as archive:
        names = archive.namelist()
        if len(names) != 1:
            raise ValueError(f"{path}: {len(names)} entries in the archive, expected 1")
        with archive.open(names[0]) as entry:
            yield from record_blocks(entry)


def sent_blocks(rows: Iterable[tuple[int, int, int, int, str]]) -> Iterator[pa.RecordBatch]:
    """Rows of the block table in batches of bounded size."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[-1])
        if size >= BATCH_CHARACTERS:
            yield pa.RecordBatch.from_arrays(list(zip(*held)), schema=BLOCK_ARROW)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays(list(zip(*held)), schema=BLOCK_ARROW)


def numbered_blocks(archive: dict) -> Iterator[tuple[int, int, int, int, str]]:
    first_row = 0
    for count, body in archive_blocks(archive["path"]):
        yield archive["seq"], archive["part"], first_row, count, body
        first_row += count


def unpack_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for archive in batch.to_pylist():
            yield from sent_blocks(numbered_blocks(archive))


def write_blocks(blocks: DataFrame, out: str) -> None:
    writer = blocks.write.option("maxRecordsPerFile", BLOCKS_PER_FILE).option("compression", "zstd")
    writer.option("parquet.block.size", ROW_GROUP_BYTES).parquet(out)


def inflated(archives: DataFrame, number: int | None = None) -> DataFrame:
    """The blocks of the ``number`` archives (``ARCHIVE_COLUMNS``), a task per archive."""
    archives = archives.select(*ARCHIVE_COLUMNS)
    tasks = max(1, archives.count() if number is None else number)
    # The largest archive is the first to start.
    spread = archives.repartitionByRange(tasks, F.desc("length"), "path")
    return spread.mapInArrow(unpack_batches, BLOCK_DDL)


def evenly_split(total: int, largest: int, cores: int) -> bool:
    """Whether archives are split well enough to be parsed as they are inflated: none is over a core's share."""
    return largest <= min(STREAMED_BYTES, total // cores)


def unpack(archives: DataFrame, number: int | None = None) -> str:
    """Unpack the ``number`` archives (``ARCHIVE_COLUMNS``) into a stored block table.

    One task streams each archive, all archives at the same time. Inflating a
    zip entry is sequential by its format, so this step only cuts records, and
    its result is written: a lost executor does not inflate again, and all
    later work is split evenly whatever the size of an archive.
    """
    out = work_folder(archives.sparkSession, "records")
    write_blocks(inflated(archives, number), out)
    return out


def read_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """The stored blocks; none if the archives held no records."""
    return spark.read.schema(BLOCK_DDL).parquet(folder)


def records(blocks: DataFrame) -> DataFrame:
    """One row per record: ``(seq, part, row, record)``, ``row`` in file order."""
    pieces = F.posexplode(F.split("body", RECORD_END)).alias("pos", "record")
    # The body ends with the mark, so the last piece is no record.
    return (
        blocks.select("seq", "part", "first_row", "row_count", pieces)
        .where(F.col("pos") < F.col("row_count"))
        .select("seq", "part", (F.col("first_row") + F.col("pos")).alias("row"), "record")
    )


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def first_lines(bodies: pa.Array) -> pa.Array:
    """Of each record of a block the line of the block that it begins in, and the block's lines at the end."""
    found = []
    for body in bodies:
        text = np.frombuffer(body.as_py().encode(), np.uint8)
        ends = np.flatnonzero(text == 0)
        inside = np.searchsorted(np.flatnonzero(text == ord("\n")), ends)  # newlines before a record's end
        found.append(np.append(0, inside + np.arange(1, len(ends) + 1)).astype(np.int32))
    return pa.array(found, pa.list_(pa.int32()))


def batch_records(blocks: DataFrame, lines: int) -> DataFrame:
    """Records with ``batch``: their extract and which ``lines`` physical lines of it they begin in.

    A record with quoted newlines takes as many lines as it has. Lines are summed
    by block, and by part of an extract, on rows without text; a running sum over
    these gives each block the lines before it.
    """
    lined = blocks.withColumn("begins", first_lines("body"))
    narrow = lined.select("seq", "part", "first_row", F.element_at("begins", -1).cast("bigint").alias("lines"))
    parts = narrow.groupBy("seq", "part").agg(F.sum("lines").alias("lines"))

    def before(*order: str) -> Column:
        window = Window.partitionBy("seq", *order[:-1]).orderBy(order[-1]).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("lines").over(window), F.lit(0))

    parts = parts.select("seq", "part", before("part").alias("of_parts"))
    offsets = narrow.select("seq", "part", "first_row", before("part", "first_row").alias("of_blocks")).join(parts, ["seq", "part"])
    offsets = offsets.select("seq", "part", "first_row", (F.col("of_parts") + F.col("of_blocks")).alias("before"))
    placed = lined.join(offsets, ["seq", "part", "first_row"])
    pieces = F.posexplode(F.arrays_zip(F.split("body", RECORD_END).alias("record"), F.col("begins").alias("line"))).alias("pos", "r")
    rows = placed.select("seq", "part", "first_row", "row_count", "before", pieces).where(F.col("pos") < F.col("row_count"))
    number = F.floor((F.col("before") + F.col("r.line")) / lines).cast("bigint")
    return rows.select(
        "seq", "part", (F.col("first_row") + F.col("pos")).alias("row"), "r.record", F.struct("seq", number.alias("number")).alias("batch")
    )
