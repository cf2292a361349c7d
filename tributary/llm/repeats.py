"""Removal of long repeated byte strings by an index of aligned contexts.

The index follows the runs of the positional Burrows-Wheeler transform: common
lengths grow inside runs and are sampled where runs end. Letters and order are
held uncompressed, for one group of contexts at a time; nothing of it is stored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import stored, whole_groups

#: Positions hashed at once in a long text, and the bits that number them.
PIECE_BITS = 18
PIECE = 1 << PIECE_BITS
MIX = np.uint64(0xD6E8FEB86659FD93)
HALF = np.uint64(32)
#: Times that a large group is split by longer keys.
SPLITS = 2
#: Stands for what is before or after a document.
OUTSIDE = 256


class Grams:
    """Rolling hashes of ``width`` bytes and the anchors among them.

    An anchor is the least hash of ``length - width + 1`` grams in a row, so every
    string of ``length`` bytes holds one, and equal strings hold equal ones at
    equal places.
    """

    def __init__(self, length: int, width: int):
        self.length, self.width, self.window = length, width, length - width + 1
        base = 0x9E3779B97F4A7C15
        most = PIECE + length
        ones = np.ones(1, np.uint64)
        self.powers = np.cumprod(np.concatenate([ones, np.full(most, base, np.uint64)]), dtype=np.uint64)
        self.inverse = np.cumprod(np.concatenate([ones, np.full(most, pow(base, -1, 1 << 64), np.uint64)]), dtype=np.uint64)
        self.letters = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)

    def hashes(self, text: np.ndarray) -> np.ndarray:
        sums = np.cumsum(self.letters[text] * self.powers[: len(text)], dtype=np.uint64)
        sums = np.concatenate([np.zeros(1, np.uint64), sums])
        found = (sums[self.width :] - sums[: -self.width]) * self.inverse[: len(text) - self.width + 1]
        found ^= found >> HALF
        found *= MIX
        return found ^ (found >> HALF)

    def anchors(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes; none in a text shorter than ``length``."""
        whole = np.frombuffer(text, np.uint8)
        places, grams = [], []
        for start in range(0, len(whole) - self.length + 1, PIECE - self.window):
            # Pieces share their windows' grams, so that no window is cut.
            found = self.hashes(whole[start : start + PIECE + self.width - 1])
            number = np.uint64(PIECE - 1)
            least = (found & ~number) | np.arange(len(found), dtype=np.uint64)
            reach = 1
            while reach * 2 <= self.window:
                least = np.minimum(least[:-reach], least[reach:])
                reach *= 2
            if reach < self.window:
                rest = self.window - reach
                least = np.minimum(least[:-rest], least[rest:])
            at = np.unique(least & number).astype(np.int64)
            places.append(at + start)
            grams.append(found[at])
        if not places:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at, first = np.unique(np.concatenate(places), return_index=True)
        return at, np.concatenate(grams)[first]


def context(text: bytes, at: int, grams: Grams) -> tuple[int, bytes]:
    """All that a string of ``length`` bytes with the anchor can cover, and its bytes before the anchor."""
    left = min(at, grams.length - grams.width)
    return left, text[at - left : at + grams.length]


def aligned_matches(groups: np.ndarray, bodies: list[bytes], lefts: list[int], length: int, margin: int) -> np.ndarray:
    """For every context, the columns at which ``length`` bytes are in another of its group.

    ``groups`` is sorted. Contexts are aligned at their anchors in column
    ``margin``. Column by column from the last, the order of the suffixes is that
    of the column after, sorted stably by the letter: the positional form of the
    Burrows-Wheeler transform. Its runs are what is worked on. Inside a run two
    neighbours' common length is one more than before; where a run ends, it is
    the least of the lengths that the run's entries were apart. These common
    lengths are the matching statistics of each context against its group.
    """
    rows, width = len(bodies), margin + length
    letters = np.full((width, rows), OUTSIDE, np.int32)
    starts, ends = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
    for i, (body, left) in enumerate(zip(bodies, lefts, strict=True)):
        starts[i], ends[i] = margin - left, margin - left + len(body)
        letters[starts[i] : ends[i], i] = np.frombuffer(body, np.uint8)
    part = np.cumsum(np.concatenate([[0], groups[1:] != groups[:-1]])).astype(np.int32) * 512
    order = np.arange(rows)
    common = np.zeros(rows, np.int32)  # with the entry before in the order
    matched = np.zeros((margin + 1, rows), bool)
    for column in range(width - 1, -1, -1):
        keys = part + letters[column][order]
        # Each group keeps its places in the order, so ``part`` needs no sorting.
        moved = np.argsort(keys, kind="stable")
        sorted_keys = keys[moved]
        same = np.concatenate([[False], sorted_keys[1:] == sorted_keys[:-1]])
        before = np.concatenate([[-1], moved[:-1]])
        inside = same & (moved == before + 1)
        grown = np.zeros(rows, np.int32)
        grown[inside] = common[moved[inside]] + 1
        heads = np.flatnonzero(same & ~inside)
        if len(heads):
            pairs = np.stack([before[heads] + 1, moved[heads] + 1], 1).ravel()
            padded = np.append(common, 0)
            grown[heads] = np.minimum.reduceat(padded, pairs)[::2] + 1
        order, common = order[moved], grown
        if column <= margin:
            long = common >= length
            either = long.copy()
            either[:-1] |= long[1:]
            hit = order[either]
            hit = hit[(starts[hit] <= column) & (column + length <= ends[hit])]
            matched[column, hit] = True
    return matched.T


def spans(columns: np.ndarray, length: int) -> list[tuple[int, int]]:
    """What the strings that start at the marked columns cover, joined."""
    at = np.flatnonzero(columns)
    if not len(at):
        return []
    cuts = np.flatnonzero(np.diff(at) > length) + 1
    return [(int(run[0]), int(run[-1]) + length) for run in np.split(at, cuts)]


def joined(found: Iterable[tuple[int, int]], most: int) -> list[tuple[int, int]]:
    """Intervals in order, touching ones joined, cut to the text."""
    out: list[list[int]] = []
    for start, end in sorted((max(0, s), min(most, e)) for s, e in found):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        elif end > start:
            out.append([start, end])
    return [(s, e) for s, e in out]


def cut(text: bytes, found: list[tuple[int, int]]) -> bytes:
    """The text without the intervals."""
    kept, at = [], 0
    for start, end in found:
        kept.append(text[at:start])
        at = end
    return b"".join([*kept, text[at:]])


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))


def _keyed(texts: DataFrame) -> DataFrame:
    """Texts with a key by which equal rows are equal."""
    mark = F.col("doc_id").isNull()
    return texts.select("doc_id", "text", F.coalesce("doc_id", F.lit(-1)).alias("k"), F.xxhash64(mark, "text").alias("h"))


def scan(docs: DataFrame, grams: Grams) -> DataFrame:
    """Every row's size, digest and anchors."""
    anchor = pa.list_(pa.struct([("pos", pa.int32()), ("gram", pa.int64()), ("ctx", pa.int64())]))

    def found(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            anchors, sizes, digests = [], [], []
            for value in texts:
                text = value.as_py()
                places, hashes = grams.anchors(text)
                rows = []
                for at, gram in zip(places.tolist(), hashes.view(np.int64).tolist(), strict=True):
                    left, body = context(text, at, grams)
                    rows.append({"pos": at, "gram": gram, "ctx": xxhash.xxh64_intdigest(body, left) - (1 << 63)})
                anchors.append(rows)
                sizes.append(len(text))
                digests.append(hashlib.sha256(text).hexdigest())
            columns = [batch.column(c) for c in ("doc_id", "k", "h")]
            columns += [pa.array(sizes, pa.int64()), pa.array(digests, pa.string()), pa.array(anchors, anchor)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "k", "h", "n_bytes", "sha256", "anchors"])

    schema = "doc_id bigint, k bigint, h bigint, n_bytes bigint, sha256 string, anchors array<struct<pos: int, gram: bigint, ctx: bigint>>"
    return _keyed(_texts(docs)).mapInArrow(found, schema)


def bodies(texts: DataFrame, grams: Grams) -> DataFrame:
    """The contexts named in ``wanted``, as bytes."""

    def sliced(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, wanted in zip(batch.column("text"), batch.column("wanted"), strict=True):
                text, rows = text.as_py(), wanted.as_py()
                if not rows:
                    continue
                cut_out = [context(text, r["pos"], grams) for r in rows]
                columns = [pa.array([r["gram"] for r in rows], pa.int64()), pa.array([r["ctx"] for r in rows], pa.int64())]
                columns += [pa.array([left for left, _ in cut_out], pa.int32()), pa.array([body for _, body in cut_out], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["gram", "ctx", "before", "body"])

    return texts.select("text", "wanted").mapInArrow(sliced, "gram bigint, ctx bigint, before int, body binary")


MARKS = "gram bigint, ctx bigint, first array<int>, last array<int>"


def index_marks(contexts: DataFrame, grams: Grams, group_rows: int, batch_rows: int = 8192) -> DataFrame:
    """Marked intervals of contexts, relative to their anchors.

    The contexts of one anchor are one group of the index, and a task indexes
    groups of some ``batch_rows`` contexts together. A group of over
    ``group_rows`` contexts is split: a string of ``length`` bytes that holds
    the known ``lo`` to ``hi`` reaches at least half of what is missing beyond
    one end, so each context goes on under two longer keys, to the left and to
    the right. What is still too large after ``SPLITS`` of these is a passage of
    nearly ``length`` bytes; of its few possible strings the hashes are counted.
    """
    length, margin = grams.length, grams.length - grams.width
    rows = contexts.withColumn("key", F.col("gram")).withColumn("lo", F.col("before")).withColumn("hi", F.col("before") + grams.width)
    found = []

    def marked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in whole_groups(batches, "key"):
            held.append(batch)
            size += batch.num_rows
            if size >= batch_rows:
                yield _indexed(held)
                held, size = [], 0
        if held:
            yield _indexed(held)

    def _indexed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        columns = aligned_matches(rows["key"].to_numpy(), rows["body"].to_pylist(), rows["before"].to_pylist(), length, margin)
        use = np.flatnonzero(columns.any(1))
        found = [spans(columns[i], length) for i in use]
        values = [rows["gram"].combine_chunks().take(pa.array(use)), rows["ctx"].combine_chunks().take(pa.array(use))]
        values += [pa.array([[s[side] - margin for s in f] for f in found], pa.list_(pa.int32())) for side in (0, 1)]
        return pa.RecordBatch.from_arrays(values, ["gram", "ctx", "first", "last"])

    for split in range(SPLITS + 1):
        counts = stored(rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "groups")
        small = rows.join(counts.where(F.col("n") <= group_rows), "key").select("key", "gram", "ctx", "before", "body")
        found.append(stored(small.repartition("key").sortWithinPartitions("key").mapInArrow(marked, MARKS), "marks"))
        if not counts.where(F.col("n") > group_rows).head(1):
            break
        large = rows.join(counts.where(F.col("n") > group_rows), "key")
        if split == SPLITS:
            found.append(stored(_counted(large, length), "marks"))
            break
        more = F.ceil((length - (F.col("hi") - F.col("lo"))) / 2).cast("int")
        sides = F.explode(F.array(F.struct((F.col("lo") - more).alias("l"), F.col("hi").alias("r")), F.struct(F.col("lo").alias("l"), (F.col("hi") + more).alias("r"))))
        longer_rows = large.withColumn("side", sides)
        longer_rows = longer_rows.where((F.col("side.l") >= 0) & (F.col("side.r") <= F.length("body")))
        longer = F.xxhash64("key", F.col("side.l") - F.col("lo"), F.substring(F.col("body"), F.col("side.l") + 1, F.col("side.r") - F.col("side.l")))
        longer_rows = longer_rows.select("gram", "ctx", "before", "body", longer.alias("key"), F.col("side.l").alias("lo"), F.col("side.r").alias("hi"))
        rows = stored(longer_rows, "split")
    out = found[0]
    for more_marks in found[1:]:
        out = out.union(more_marks)
    return out


def _counted(contexts: DataFrame, length: int) -> DataFrame:
    """Marks of the strings over ``lo`` to ``hi`` that several contexts hold at the same place."""
    starts = F.sequence(F.greatest(F.lit(0), F.col("hi") - length), F.least(F.col("lo"), F.length("body") - length))
    windows = contexts.where(F.greatest(F.lit(0), F.col("hi") - length) <= F.least(F.col("lo"), F.length("body") - length))
    windows = windows.select("key", "gram", "ctx", "before", "body", F.explode(starts).alias("at"))
    string = F.xxhash64(F.substring(F.col("body"), F.col("at") + 1, F.lit(length)))
    windows = stored(windows.select("key", "gram", "ctx", (F.col("at") - F.col("before")).alias("at"), string.alias("string")), "strings")
    several = windows.groupBy("key", "at", "string").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    found = windows.join(several, ["key", "at", "string"])
    # At most as many places as a context has; they leave as the few spans they cover.
    found = found.groupBy("gram", "ctx").agg(F.sort_array(F.collect_set("at")).alias("places"))

    def covered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = []
            for value in batch.column("places").to_pylist():
                at = np.array(value)
                parts = np.split(at, np.flatnonzero(np.diff(at) > length) + 1)
                runs.append([(int(p[0]), int(p[-1]) + length) for p in parts])
            ends = [pa.array([[r[side] for r in row] for row in runs], pa.list_(pa.int32())) for side in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("gram"), batch.column("ctx"), *ends], ["gram", "ctx", "first", "last"])

    return found.mapInArrow(covered, MARKS)


def remove_repeats(docs: DataFrame, length: int = 400, width: int = 200, group_rows: int = 4096) -> DataFrame:
    """Every row of ``docs`` without the bytes of strings that start elsewhere too.

    A byte goes if a string of ``length`` bytes over it, within the UTF-8 bytes of
    its document, also starts at any other place of any document, its own
    included; all is judged on the input. Returns ``doc_id, n_bytes, n_removed,
    n_spans, kept_sha256``, and ``removed`` (start and end of each span). A null
    text is empty; a text shorter than ``length`` loses nothing. Repeated rows
    are documents of their own, so they remove each other. Rows without an id
    count like any other. Columns beyond ``doc_id`` and ``text`` are not read.

    Anchors, chosen by content, name the strings' places. Anchors that occur once
    are done with; of the others, a context that occurs twice is repeated as a
    whole, and the distinct contexts of one anchor go to the run-length index.
    Copies thus meet as counts before any text is moved, and the index holds
    each context once.
    """
    grams = Grams(length, width)
    base = stored(scan(docs, grams).withColumn("row", F.monotonically_increasing_id()), "anchors")
    places = base.select("row", F.inline("anchors"))
    counts = places.groupBy("gram").agg(F.count("*").alias("n"), (F.min("ctx") != F.max("ctx")).alias("mixed"))
    counts = stored(counts.where("n > 1").select("gram", "mixed"), "grams")
    repeated = stored(places.join(counts, "gram"), "repeated")

    # Of equal contexts of a mixed anchor the first one stands for all.
    distinct = repeated.where("mixed").groupBy("gram", "ctx").agg(F.count("*").alias("copies"), F.min(F.struct("row", "pos")).alias("at"))
    distinct = stored(distinct, "contexts")
    wanted = distinct.select(F.col("at.row").alias("row"), F.struct(F.col("at.pos").alias("pos"), "gram", "ctx").alias("w"))
    wanted = wanted.groupBy("row").agg(F.collect_list("w").alias("wanted"))
    involved = repeated.select("row").distinct().join(wanted, "row", "left").join(base.select("row", "k", "h"), "row")
    involved = involved.groupBy("k", "h").agg(F.flatten(F.collect_list("wanted")).alias("wanted"))
    texts = stored(_keyed(_texts(docs)).dropDuplicates(["k", "h"]).join(involved, ["k", "h"]), "involved")

    marks = index_marks(bodies(texts, grams), grams, group_rows)
    margin = length - width
    alike = repeated.where("NOT mixed").select("row", "pos").union(
        repeated.where("mixed").join(distinct.where("copies > 1").select("gram", "ctx"), ["gram", "ctx"]).select("row", "pos")
    )
    whole = alike.select("row", (F.col("pos") - margin).alias("start"), (F.col("pos") + length).alias("end"))
    parts = repeated.where("mixed").join(marks, ["gram", "ctx"]).select("row", "pos", F.inline(F.arrays_zip("first", "last")))
    parts = parts.select("row", (F.col("pos") + F.col("first")).alias("start"), (F.col("pos") + F.col("last")).alias("end"))
    intervals = whole.union(parts).groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("intervals"))
    keyed = intervals.join(base.select("row", "k", "h"), "row").dropDuplicates(["k", "h"]).select("k", "h", "intervals")

    schema = "k bigint, h bigint, removed array<struct<start: int, end: int>>, kept string"
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def applied(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, kept = [], []
            for text, found in zip(batch.column("text"), batch.column("intervals"), strict=True):
                text = text.as_py()
                runs = joined([(x["start"], x["end"]) for x in found.as_py()], len(text))
                removed.append([{"start": s, "end": e} for s, e in runs])
                kept.append(hashlib.sha256(cut(text, runs)).hexdigest())
            columns = [batch.column("k"), batch.column("h"), pa.array(removed, kind), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["k", "h", "removed", "kept"])

    changed = texts.select("k", "h", "text").join(keyed, ["k", "h"]).select("k", "h", "text", "intervals").mapInArrow(applied, schema)
    removed = F.coalesce("removed", F.array().cast("array<struct<start: int, end: int>>"))
    rows = base.select("doc_id", "k", "h", "n_bytes", "sha256").join(changed, ["k", "h"], "left")
    return rows.select(
        "doc_id",
        "n_bytes",
        F.aggregate(removed, F.lit(0).cast("bigint"), lambda total, x: total + x.end - x.start).alias("n_removed"),
        F.size(removed).cast("bigint").alias("n_spans"),
        F.coalesce("kept", "sha256").alias("kept_sha256"),
        removed.alias("removed"),
    )
