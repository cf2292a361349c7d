"""Helpers that several operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.storage import work_folder

#: One word of a text: no ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """The rows, written once to the shared folder and read from there.

    Cuts the lineage: what follows survives the loss of executors without
    computing the rows again, and several readers share one computation.
    """
    path = work_folder(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def byte_texts(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of a text column, one value at a time; a null is empty."""
    for value in column.cast(pa.binary()):
        yield value.as_py() or b""


def give_back() -> None:
    """Return memory that a task has freed to the system; its worker goes on to other stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library
    if trim:
        trim(0)


def training_side(doc_id: Column, remainder: int = 2, parts: int = 4) -> Column:
    """False for the rows that are held out: crc32 of the id as text mod ``parts``."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts != remainder, F.lit(False))


def whole_groups(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """Batches cut anew so that rows of one key, which follow each other, stay together."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        changes = np.flatnonzero(keys[1:] != keys[:-1])
        if rest and keys[0] != rest[-1].column(key)[-1].as_py():
            yield _joined(rest)
            rest = []
        if len(changes):
            cut = int(changes[-1]) + 1
            yield _joined([*rest, batch.slice(0, cut)])
            rest = [batch.slice(cut)]
        else:
            rest.append(batch)
    if rest:
        yield _joined(rest)


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    if len(batches) == 1:
        return batches[0]
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def run_bounds(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of equal neighbours."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    return np.concatenate([[0], cuts]), np.concatenate([cuts, [len(keys)]])
