"""Nearest neighbours by a block matrix join over int8 codes with error bounds."""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a tile's product at once, queries and candidates.
TILE = (1024, 2048)
#: Relative slack that covers the rounding of sums of squares in double.
SLACK = 1e-9
#: More than what squares lose that are too small for a double.
TINY = 1e-290
#: Tasks for the tiles; a task takes several tiles, one after another, beyond that.
MOST_TASKS = 20_000
FOUND = "query_id bigint, vec_id bigint, score double"


def usable(vector: Column) -> Column:
    """Whether a vector is there, finite in every component, and not zero."""
    number = vector.cast("array<double>")
    finite = F.forall(number, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(number, lambda x: x != 0), F.lit(False))


class Codes:
    """Vectors, their int8 codes, and what bounds the error of the codes.

    All numbers are in units of a power of two of the row's own, ``unit``, so that
    no square of a component, however large or small, leaves the range of a double.
    """

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors.astype(np.float64)
        top = np.abs(self.vectors).max(1)
        self.unit = np.ldexp(1.0, np.maximum(np.frexp(top)[1] - 1, -1000))
        own = self.vectors / self.unit[:, None]
        self.scale = np.maximum(np.abs(own).max(1) / 127, np.finfo(float).tiny)
        self.codes = np.rint(own / self.scale[:, None]).astype(np.int8)
        near = self.codes * self.scale[:, None]
        self.lost = np.linalg.norm(own - near, axis=1)
        self.near_norm = np.linalg.norm(near, axis=1)
        self.norm = np.linalg.norm(own, axis=1)

    def part(self, start: int, end: int) -> Codes:
        part = object.__new__(Codes)
        for name, value in vars(self).items():
            setattr(part, name, value[start:end])
        return part


def products(one: Codes, other: Codes) -> np.ndarray:
    """Exact products of codes; sums stay whole numbers in the float type used."""
    kind = np.float32 if one.codes.shape[1] * 127 * 127 < 1 << 24 else np.float64
    return one.codes.astype(kind) @ other.codes.astype(kind).T


def bounds(one: Codes, other: Codes) -> tuple[np.ndarray, np.ndarray, float]:
    """Least and largest squared distances that the codes allow, and the unit of the distances.

    With x = near + lost for both vectors, the product of the vectors differs
    from that of the codes by at most ``near * lost' + lost * norm'``. The unit is
    the largest of the rows' own; what vanishes beside it is covered by ``TINY``.
    """
    unit = float(max(one.unit.max(), other.unit.max()))
    mine, theirs = one.unit / unit, other.unit / unit
    dot = products(one, other) * np.outer(one.scale * mine, other.scale * theirs)
    error = np.outer(one.near_norm * mine, other.lost * theirs) + np.outer(one.lost * mine, other.norm * theirs)
    squares = ((one.norm * mine) ** 2)[:, None] + ((other.norm * theirs) ** 2)[None]
    error = 2 * error + SLACK * squares + TINY
    return squares - 2 * dot - error, squares - 2 * dot + error, unit


def distances(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows, components summed in order.

    Where squares leave the range of a double they are taken in units of a power
    of two, which changes no digit of the others.
    """
    total = np.zeros(len(one))
    with np.errstate(over="ignore", under="ignore"):
        for axis in range(one.shape[1]):
            gap = one[:, axis] - other[:, axis]
            total += gap * gap
        far = ~((total > 1e-280) & (total < np.inf)) & (one != other).any(1)
        found = np.sqrt(total)
        if far.any():
            # Halves first, as the difference of two finite numbers may not be finite.
            gaps = one[far] / 2 - other[far] / 2
            unit = np.ldexp(1.0, np.clip(np.frexp(np.abs(gaps).max(1))[1], -1000, 1000))
            found[far] = np.sqrt(((gaps / unit[:, None]) ** 2).sum(1)) * unit * 2
    return found


class Nearest:
    """For each query a heap of the ``k`` nearest so far, the farthest on top."""

    def __init__(self, k: int):
        self.k, self.heaps = k, {}

    def offer(self, query: int, score: float, vec_id: int) -> None:
        heap = self.heaps.setdefault(query, [])
        if len(heap) < self.k:
            heapq.heappush(heap, (-score, -vec_id))
        else:
            heapq.heappushpop(heap, (-score, -vec_id))

    def worst(self, query: int) -> tuple[float, int]:
        heap = self.heaps.get(query, ())
        return (-heap[0][0], -heap[0][1]) if len(heap) == self.k else (np.inf, 0)

    def rows(self) -> Iterator[tuple[int, int, float, int]]:
        """Query, id, score and rank."""
        for query, heap in self.heaps.items():
            for rank, (score, vec_id) in enumerate(sorted((-s, -v) for s, v in heap), 1):
                yield query, vec_id, score, rank


def search_tile(queries: Codes, query_ids: np.ndarray, rows: Codes, row_ids: np.ndarray, best: Nearest) -> None:
    """Offer the rows of a tile that the bounds leave to the queries' heaps."""
    for start in range(0, len(query_ids), TILE[0]):
        end = min(start + TILE[0], len(query_ids))
        asked, ids = queries.part(start, end), query_ids[start:end]
        least, most, unit = bounds(asked, rows)
        own = ids[:, None] == row_ids[None]
        most[own] = np.inf
        worst = [best.worst(int(q)) for q in ids]
        with np.errstate(over="ignore"):
            limit = (np.array([w[0] for w in worst]) / unit) ** 2 * (1 + SLACK) + TINY
        if most.shape[1] >= best.k:
            limit = np.minimum(limit, np.partition(most, best.k - 1, axis=1)[:, best.k - 1])
        at, to = np.nonzero(~(least > limit[:, None]) & ~own)
        for piece in range(0, len(at), 1 << 18):
            a, t = at[piece : piece + (1 << 18)], to[piece : piece + (1 << 18)]
            scores = distances(asked.vectors[a], rows.vectors[t])
            far, last = np.array([w[0] for w in worst])[a], np.array([w[1] for w in worst])[a]
            better = (scores < far) | ((scores == far) & (row_ids[t] < last))
            for q, score, vec_id in zip(ids[a[better]].tolist(), scores[better].tolist(), row_ids[t[better]].tolist(), strict=True):
                best.offer(q, score, vec_id)


def nearest(queries: DataFrame, rows: DataFrame, k: int = 10, query_block: int = 4096, row_block: int = 4096) -> DataFrame:
    """The ``k`` nearest ``rows`` of every query, by Euclidean distance in double.

    Both frames have ``vec_id`` and ``embedding``; other columns are not read.
    Returns ``query_id, rank, vec_id, score``, ties to the smaller ``vec_id``;
    all rows if there are fewer than ``k``. A row with the query's own id is no
    candidate; a repeated row counts as often as it is there, a repeated query
    asks once. Vectors that are null, zero, or hold a null or a value that is not
    finite take no part, nor do rows without an id; vectors of different length
    are not compared. Empty tables give an empty table.

    Queries form blocks, rows groups, both by hash and of bounded size, and each
    pair of them is one tile: codes are multiplied, bounds drop what cannot be
    among the ``k``, the rest is measured on the original vectors. A task holds
    one block of queries and streams the rows. Heaps of tiles are merged by query.
    """

    def checked(frame: DataFrame) -> DataFrame:
        frame = frame.select(F.col("vec_id").cast("bigint").alias("id"), F.col("embedding").alias("vector"))
        return frame.where(F.col("id").isNotNull() & usable(F.col("vector"))).withColumn("dim", F.size("vector"))

    asked, rows = checked(queries).dropDuplicates(["id"]), checked(rows)
    blocks = max(1, -(-asked.count() // query_block))
    groups = max(1, -(-rows.count() // row_block))

    def dealt(n: int) -> Column:
        return F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")

    def all_of(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    tiles = asked.select(all_of(groups).alias("g"), dealt(blocks).alias("b"), "dim", F.lit(0).alias("side"), "id", "vector").union(
        rows.select(dealt(groups).alias("g"), all_of(blocks).alias("b"), "dim", F.lit(1).alias("side"), "id", "vector")
    )
    tiles = tiles.repartition(min(blocks * groups, MOST_TASKS), "g", "b", "dim").sortWithinPartitions("g", "b", "dim", "side", "id")

    def searched(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, asked, best = None, [], Nearest(k)
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("g", "b", "dim", "side")], 1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1), len(keys)]
            for start, end in zip(cuts, cuts[1:], strict=False):
                if start == end:
                    continue
                *tile, side = keys[start].tolist()
                if tile != key:
                    yield _found(best)
                    key, asked, best = tile, [], Nearest(k)
                part = batch.slice(start, end - start)
                ids = part.column("id").to_numpy()
                vectors = part.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
                if side == 0:
                    asked.append((ids, vectors))
                    continue
                if len(asked) > 1 or asked and not isinstance(asked[0][1], Codes):
                    asked = [(np.concatenate([a for a, _ in asked]), Codes(np.concatenate([v for _, v in asked])))]
                if asked:
                    for at in range(0, len(ids), TILE[1]):
                        search_tile(asked[0][1], asked[0][0], Codes(vectors[at : at + TILE[1]]), ids[at : at + TILE[1]], best)
        yield _found(best)

    def _found(best: Nearest) -> pa.RecordBatch:
        queries, ids, scores, _ = tuple(zip(*best.rows(), strict=True)) or ((), (), (), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(queries, pa.int64()), pa.array(ids, pa.int64()), pa.array(scores, pa.float64())], ["query_id", "vec_id", "score"]
        )

    def merged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Nearest(k)
        for batch in batches:
            for query, vec_id, score in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                best.offer(query, score, vec_id)
        queries, ids, scores, ranks = tuple(zip(*best.rows(), strict=True)) or ((), (), (), ())
        columns = [pa.array(queries, pa.int64()), pa.array(ranks, pa.int32()), pa.array(ids, pa.int64()), pa.array(scores, pa.float64())]
        yield pa.RecordBatch.from_arrays(columns, ["query_id", "rank", "vec_id", "score"])

    return tiles.mapInArrow(searched, FOUND).repartition("query_id").mapInArrow(merged, "query_id bigint, rank int, vec_id bigint, score double")
