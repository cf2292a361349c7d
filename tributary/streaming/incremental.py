"""Extracts applied to a table as their archives land, as a file stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tributary.operators.upsert import LAST
from tributary.plans.load import extract_rows
from tributary.sources.archive import FILE_DDL, read_blocks, unpack
from tributary.sources.tables import KeyedTable
from tributary.storage import read_json, remove_folder


def follow(
    table: KeyedTable,
    landing: str,
    checkpoint: str,
    sequence: str = r"(?i)(\d+)\.zip$",
    archives_per_batch: int = 100,
    on_duplicate: str = LAST,
    available_now: bool = True,
) -> StreamingQuery:
    """Upsert the archives that land in ``landing``, each one extract.

    The stream carries paths only. ``sequence`` finds an extract's number in
    its path: files do not come in that order, so a row yields to one of a
    later extract whichever was applied first. A micro-batch is committed
    together with its number and the id that the checkpoint gave the stream, and
    skipped when Spark repeats it; a new checkpoint is a new stream.
    """
    spark = table.spark
    number = F.regexp_extract("path", sequence, 1)
    unnumbered = F.raise_error(F.concat(F.lit("no extract number in "), F.col("path")))
    archives = (
        spark.readStream.format("binaryFile")
        .schema(FILE_DDL)
        .option("pathGlobFilter", "*.[zZ][iI][pP]")
        .option("maxFilesPerTrigger", archives_per_batch)
        .load(landing)
        .select(
            F.when(number == "", unnumbered).otherwise(number.cast("bigint")).alias("seq"),
            F.lit(0).cast("bigint").alias("part"),
            "path",
            "length",
        )
    )

    def apply(batch: DataFrame, batch_id: int) -> None:
        bounds = batch.agg(
            F.min("seq").alias("first"), F.max("seq").alias("last"), F.sum("length").alias("bytes")
        ).first()
        if bounds["first"] is None:
            return
        stream = read_json(f"{checkpoint.rstrip('/')}/metadata")["id"]
        folder = unpack(batch)
        try:
            rows = extract_rows(read_blocks(spark, folder), table.spec, on_duplicate)
            table.land(
                rows, bounds["first"], bounds["last"], bounds["bytes"], source=stream, batch=batch_id
            )
        finally:
            remove_folder(folder)

    writer = archives.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
