"""SimHash near-duplicates by a grid join over segment bit counts."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations, product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import byte_texts, run_bounds, stored, whole_groups
from tributary.llm.components import components

SEED = 42
#: Shingles hashed at once; long texts are counted in pieces of this size.
PIECE = 1 << 16
#: Segments are of two bits, so that a bit count is 0, 1 or 2.
SEGMENTS = 32
EVEN = np.uint64(0x5555555555555555)
ONE = np.uint64(1)
#: A cell of at most so many rows is compared pair by pair.
SMALL_CELL = 32


def fingerprint(text: bytes, shingle_words: int) -> int:
    """SimHash of the lower-cased word shingles; 0 without a word."""
    words = text.lower().split()
    if not words:
        return 0
    width = min(shingle_words, len(words))
    total, ones = len(words) - width + 1, np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for start in range(0, total, PIECE):
        piece = words[start : start + PIECE + width - 1]
        grams = zip(*(piece[i:] for i in range(width)), strict=False)
        hashes = np.array([digest(b" ".join(g), SEED) for g in grams], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = 4) -> DataFrame:
    """``(doc_id, fp)`` per row, the 64 bits as a signed number."""
    schema = "doc_id bigint, fp bigint"

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t, shingle_words) for t in byte_texts(batch.column("text"))]
            fp = pa.array(np.array(prints, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), fp], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(hashed, schema)


def embedding(prints: np.ndarray) -> np.ndarray:
    """Bit counts of all segments, each in unary (0, 01, 11).

    The number of bits in which two embeddings differ is the Manhattan distance
    of the segments' bit counts, which never exceeds the fingerprints' distance.
    """
    low, high = prints & EVEN, (prints >> ONE) & EVEN
    return (low | high) | ((low & high) << ONE)


def _steps(width: int, budget: int) -> list[tuple[int, ...]]:
    """Moves in the grid of up to ``budget`` in all; one of each pair of opposites."""
    moves = []
    for size in range(1, budget + 1):
        for axes in combinations(range(width), size):
            for values in product([v for v in range(-budget, budget + 1) if v], repeat=size):
                if sum(map(abs, values)) <= budget and values[0] > 0:
                    step = [0] * width
                    for axis, value in zip(axes, values, strict=True):
                        step[axis] = value
                    moves.append(tuple(step))
    return moves


def cells(prints: DataFrame, max_bits: int, groups: int) -> DataFrame:
    """Grid cells ``(cell, visitor, fp)`` that hold every pair within reach.

    The segments are split into ``groups``. Of two fingerprints at most
    ``max_bits`` apart, one group's counts are at most ``max_bits // groups``
    apart, so one of the two, visiting the cells that near, meets the other at
    home in its own cell.
    """
    bounds = np.linspace(0, SEGMENTS, groups + 1).astype(int)
    reach = max_bits // groups

    def placed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signed = batch.column("fp").to_numpy()
            prints = signed.view(np.uint64)
            counts = np.stack([np.bitwise_count((prints >> np.uint64(2 * s)) & np.uint64(3)) for s in range(SEGMENTS)], 1)
            for group in range(groups):
                own = counts[:, bounds[group] : bounds[group + 1]].astype(np.int64)
                powers = 3 ** np.arange(own.shape[1])
                home = (own * powers).sum(1) * groups + group
                yield _rows(home, 0, signed)
                for step in _steps(own.shape[1], reach):
                    axes = np.flatnonzero(step)
                    moved = own[:, axes] + np.array(step)[axes]
                    inside = ((moved >= 0) & (moved <= 2)).all(1)
                    yield _rows((home + int(np.dot(step, powers)) * groups)[inside], 1, signed[inside])

    def _rows(cell: np.ndarray, visitor: int, prints: np.ndarray) -> pa.RecordBatch:
        columns = [pa.array(cell), pa.array(np.full(len(cell), visitor, np.int8)), pa.array(prints)]
        return pa.RecordBatch.from_arrays(columns, ["cell", "visitor", "fp"])

    return prints.select("fp").mapInArrow(placed, "cell bigint, visitor tinyint, fp bigint")


def _close(one: np.ndarray, other: np.ndarray, max_bits: int) -> np.ndarray:
    """Places of the pairs within reach: the lower bound first, then the bits."""
    near = np.flatnonzero(np.bitwise_count(embedding(one) ^ embedding(other)) <= max_bits)
    one = one if one.ndim == 0 else one[near]
    return near[np.bitwise_count(one ^ other[near]) <= max_bits]


def _small_cells(prints: np.ndarray, at: np.ndarray, ends: np.ndarray, max_bits: int) -> Iterator[np.ndarray]:
    """Links of the homes ``at`` with all rows after them in their cell."""
    for piece in range(0, len(at), PIECE):
        first, last = at[piece : piece + PIECE], ends[piece : piece + PIECE]
        many = last - first - 1
        left = np.repeat(first, many)
        right = np.arange(len(left)) - np.repeat(np.cumsum(many) - many, many) + left + 1
        hits = _close(prints[left], prints[right], max_bits)
        yield np.stack([prints[left[hits]], prints[right[hits]]])


def _large_cell(prints: np.ndarray, homes: int, max_bits: int) -> Iterator[np.ndarray]:
    """A forest that connects what the links of the cell connect.

    Rows already reached are compared no more: a dense heap of near copies is
    done after few comparisons.
    """
    left_homes, left_guests = np.arange(homes), np.arange(homes, len(prints))
    while len(left_homes):
        queue, left_homes = [left_homes[0]], left_homes[1:]
        while queue:
            at = queue.pop()
            for home_side in (True, False):
                rest = left_homes if home_side else left_guests
                if not home_side and at >= homes or not len(rest):
                    continue
                hits = _close(prints[at], prints[rest], max_bits)
                if len(hits):
                    found = rest[hits]
                    yield np.stack([np.full(len(found), prints[at]), prints[found]])
                    queue.extend(found)
                    rest = np.delete(rest, hits)
                    left_homes, left_guests = (rest, left_guests) if home_side else (left_homes, rest)


def links(prints: DataFrame, max_bits: int = 4, groups: int = 3) -> DataFrame:
    """Verified links ``(a, b)`` whose components are those of all links.

    ``prints`` has distinct fingerprints. A cell's rows are sorted, homes first,
    and come as a stream.
    """
    schema = "a bigint, b bigint"

    def verified(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole_groups(batches, "cell"):
            prints = batch.column("fp").to_numpy().view(np.uint64)
            starts, ends = run_bounds(batch.column("cell").to_numpy())
            homes = np.add.reduceat(batch.column("visitor").to_numpy() == 0, starts, dtype=np.int64)
            small = ends - starts <= SMALL_CELL
            many = homes[small]
            first = np.repeat(starts[small], many)
            at = first + np.arange(len(first)) - np.repeat(np.cumsum(many) - many, many)
            found = list(_small_cells(prints, at, np.repeat(ends[small], many), max_bits))
            for start, end, home in zip(starts[~small], ends[~small], homes[~small], strict=True):
                found.extend(_large_cell(prints[start:end], home, max_bits))
            pairs = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.uint64)
            pairs = np.unique(pairs, axis=1).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0].copy()), pa.array(pairs[1].copy())], ["a", "b"])

    grid = cells(prints, max_bits, groups).repartition("cell").sortWithinPartitions("cell", "visitor")
    return grid.mapInArrow(verified, schema)


def near_duplicates(docs: DataFrame, shingle_words: int = 4, max_bits: int = 4, groups: int = 3) -> DataFrame:
    """Fingerprint and near-duplicate group of every row of ``docs``.

    ``docs`` has ``doc_id`` and ``text``; other columns, whatever their names,
    are not read. Returns ``doc_id, fingerprint`` (16 hex digits) and
    ``component_id``, the smallest id reachable over fingerprints that differ in
    at most ``max_bits`` bits. A null or empty text has fingerprint zero and
    links like any other. A row without an id gets its fingerprint but belongs
    to no group (null) and links nothing. Repeated rows give repeated rows; an
    empty table gives an empty table.

    Rows of one fingerprint are one node, so a large group of copies costs one
    node after a partial aggregate; near copies cost one node per fingerprint.
    """
    prints = stored(fingerprints(docs, shingle_words), "fingerprints")
    nodes = stored(prints.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    roots = components(links(nodes, max_bits, groups))
    placed = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    names = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = placed.join(names, "root").select("fp", "component_id")
    known = prints.join(named, "fp", "left")
    return known.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, shingle_words: int = 4, max_bits: int = 4) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its near-duplicate group.

    Of rows that share such an id the one with the least hash of its values stays,
    the least values if hashes are equal, so reruns agree. Rows without an id stay.
    Rows that share an id meet as one per task before texts move.
    """
    groups = near_duplicates(docs, shingle_words, max_bits)
    kept = stored(groups.where("doc_id = component_id").select("doc_id").distinct(), "kept")
    named = docs.join(kept, "doc_id", "left_semi")
    rest = [c for c in docs.columns if c != "doc_id"]
    row = F.struct(F.xxhash64(*rest).alias("mark"), F.struct(*rest).alias("rest"))
    named = named.groupBy("doc_id").agg(F.min(row).alias("row"))
    named = named.select("doc_id", *[F.col("row.rest").getField(c).alias(c) for c in rest]).select(*docs.columns)
    return named.unionByName(docs.where("doc_id IS NULL"))
