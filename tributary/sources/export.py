"""Extracts written the way they are published: CSV in zips, listing pages."""

from __future__ import annotations

import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.sources.extract import WRITE_OPTIONS, as_text
from tributary.sources.listing import LINK, NEXT_PAGE, PLUGIN, URL
from tributary.storage import resolve

# A seventh smaller than level 1, for a third of the time that level 6 takes.
LEVEL = 3


def csv_records(rows: DataFrame) -> DataFrame:
    """One CSV record per row, in the column ``record``."""
    text = as_text(rows)
    record = F.to_csv(F.struct(*[F.col(c) for c in text.columns]), WRITE_OPTIONS)
    return text.select(record.alias("record"))


def header_record(columns: list[str]) -> str:
    """The first line of a published extract."""
    return ",".join(columns)


def write_archives(records: DataFrame, folder: str, header: list[str]) -> int:
    """Zip archives of one CSV entry each, one per partition of ``records``.

    Archive numbers follow the partitions. Each task streams its partition;
    the caller's partitioning bounds the size of an archive.
    """
    first_line = f"{header_record(header)}\n".encode()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        number = context.partitionId()
        system, inner = resolve(folder)
        system.create_dir(inner, recursive=True)
        draft = f"{inner}/.{number:08d}.{context.taskAttemptId()}"
        count = 0
        with (
            system.open_output_stream(draft) as sink,
            zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED, compresslevel=LEVEL) as archive,
            archive.open(f"extract-{number:08d}.csv", "w", force_zip64=True) as entry,
        ):
            entry.write(first_line)
            for batch in batches:
                entry.write("".join(f"{record}\n" for record in batch.column("record").to_pylist()).encode())
                count += batch.num_rows
        system.move(draft, f"{inner}/extract-{number:08d}.zip")
        yield pa.RecordBatch.from_pydict({"rows": [count]})

    written = records.select("record").mapInArrow(write, "rows bigint")
    return written.agg(F.sum("rows")).first()[0]


def write_listing(links: DataFrame, path: str, items: str) -> None:
    """Listing pages of ``(page, plugin, link)``, one JSON file per page.

    ``page`` is text that sorts in page order; a page holds few items. Each page
    names the next, and its own address; the files' names tell nothing.
    """
    item = F.struct(F.col("plugin").alias(PLUGIN), F.col("link").alias(LINK))
    pages = links.groupBy("page").agg(F.sort_array(F.collect_list(item)).alias(items))
    # Few narrow rows: the page names alone.
    following = pages.select(F.col("page").alias("name"), F.lead("page").over(Window.orderBy("page")).alias("next"))
    pages = pages.join(following, F.col("page") == F.col("name"))
    address = F.concat(F.lit("page/"), F.col("page"))
    pages = pages.select(F.xxhash64("page").alias("file"), items, address.alias(URL), F.concat(F.lit("page/"), F.col("next")).alias(NEXT_PAGE))
    pages.write.partitionBy("file").option("ignoreNullFields", "false").json(path)
