"""Quality scores by learned vectors of hashed words and character n-grams."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import training_side

#: Rows of the table of vectors.
BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS
SHIFT = np.uint64(64 - BUCKET_BITS)
MIX = np.uint64(0x9E3779B97F4A7C15)
HALF = np.uint64(32)
#: Lengths of the character n-grams; a word's ends are characters of it.
GRAMS = (3, 4)
#: Keep words and pairs of equal words apart from n-grams.
WORD, PAIR = np.uint64(1 << 32), np.uint64(2 << 32)
#: Words hashed at once; longer texts go in pieces of whole words.
PIECE = 1 << 15


def _buckets(hashes: np.ndarray) -> np.ndarray:
    mixed = (hashes ^ (hashes >> HALF)) * MIX
    return ((mixed ^ (mixed >> HALF)) * MIX >> SHIFT).astype(np.int32)


def features(text: str | None) -> Iterator[np.ndarray]:
    """Buckets of all words and n-grams of a whole text, repeats included, piece by piece.

    Case counts. An n-gram lies inside one word with the blanks around it. A pair
    of equal words is one term, whichever word it is; other pairs are none.
    """
    words = (text or "").split()
    before = np.zeros(0, np.uint64)
    for start in range(0, len(words), PIECE):
        piece = words[start : start + PIECE]
        hashes = np.array([zlib.crc32(w.encode()) for w in piece], np.uint64)
        yield _buckets(hashes + WORD)
        beside = np.concatenate([before, hashes])
        yield _buckets(np.full(int((beside[1:] == beside[:-1]).sum()), PAIR))
        before = hashes[-1:]
        points = np.frombuffer((" " + " ".join(piece) + " ").encode("utf-32-le"), np.uint32).astype(np.uint64)
        blank = points == 32
        for size in GRAMS:
            if len(points) < size:
                continue
            ends = len(points) - size + 1
            hashes, whole = points[:ends], np.ones(ends, bool)
            for at in range(1, size):
                hashes = hashes * MIX + points[at : at + ends]
                if at < size - 1:
                    whole &= ~blank[at : at + ends]
            yield _buckets(hashes[whole] + np.uint64(size))


def counted(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and how often it has each."""
    found = np.zeros(BUCKETS, np.int64)
    for buckets in features(text):
        found += np.bincount(buckets, minlength=BUCKETS)
    used = np.flatnonzero(found)
    return used.astype(np.int32), found[used].astype(np.float32)


def softmax(values: np.ndarray) -> np.ndarray:
    raised = np.exp(values - values.max())
    return raised / raised.sum()


@dataclass
class Embeddings:
    """A vector per bucket, and the output layer over their average."""

    vectors: np.ndarray
    output: np.ndarray
    bias: np.ndarray

    def average(self, text: str | None) -> np.ndarray:
        """Mean of the vectors of all words and n-grams; zero if there is none."""
        total, number = np.zeros(self.vectors.shape[1], np.float64), 0
        for buckets in features(text):
            total += self.vectors[buckets].sum(0, dtype=np.float64)
            number += len(buckets)
        return total / max(1, number)

    def score(self, text: str | None) -> float:
        """Probability of label 1."""
        return float(softmax(self.output @ self.average(text) + self.bias)[1])


def train(
    rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, size: int = 16, epochs: int = 10, rate: float = 0.1
) -> Embeddings:
    """Stochastic gradient descent, one document a step, in an order drawn with a fixed seed.

    The step of a vector shrinks with the gradients it has had (AdaGrad by row),
    as a vector's gradient is divided by the length of the text. No rows, or rows
    of one class alone, give the smoothed rate of the class for every text.
    """
    rate_of_one = (labels.sum() + 0.5) / (len(labels) + 1) if len(labels) else 0.5
    bias = np.log(np.array([1 - rate_of_one, rate_of_one]))
    dice = np.random.default_rng(0)
    output = np.zeros((2, size))
    if not 0 < labels.sum() < len(labels):
        return Embeddings(np.zeros((BUCKETS, size), np.float32), output, bias)
    vectors = dice.uniform(-1 / size, 1 / size, (BUCKETS, size)).astype(np.float32)
    seen, seen_output, seen_bias = np.zeros(BUCKETS, np.float32), np.full(2, 1e-8), np.full(2, 1e-8)
    targets = np.eye(2)
    steps, step = epochs * len(rows), 0
    for _ in range(epochs):
        for i in dice.permutation(len(rows)):
            buckets, counts = rows[i]
            now = rate * (1 - step / steps)
            step += 1
            share = counts / max(1.0, counts.sum())
            known = vectors[buckets]
            mean = share @ known
            error = softmax(output @ mean + bias) - targets[int(labels[i])]
            back = (output.T @ error).astype(np.float32)
            output_gradient = np.outer(error, mean)
            seen_output += (output_gradient**2).mean(1)
            seen_bias += error**2
            output -= now * output_gradient / np.sqrt(seen_output)[:, None]
            bias -= now * error / np.sqrt(seen_bias)
            strength = float((back**2).mean())
            if strength and len(buckets):
                sums = seen[buckets] + share**2 * strength
                seen[buckets] = sums
                vectors[buckets] = known - (now * share / np.sqrt(sums + 1e-20))[:, None] * back
    return Embeddings(vectors, output, bias)


def fit(docs: DataFrame, labels: DataFrame, sample: int = 6000, held_out: int = 0, **settings) -> Embeddings:
    """Vectors and output layer fitted on about ``sample`` labelled rows, chosen by hash of the id.

    Rows whose crc32 of the id mod 5 is ``held_out`` are never used. ``sample``
    bounds what one task trains on; the texts of the sample are read whole. Of
    several labels of one id the highest counts; null labels and ids are left out.
    """
    usable = labels.select(F.col("doc_id").cast("bigint").alias("id"), F.col("quality").cast("int").alias("quality"))
    learned = training_side(F.col("id"), held_out, 5)
    usable = usable.where(learned).where("quality IS NOT NULL").groupBy("id").agg(F.max("quality").alias("quality"))
    share = min(1.0, sample / max(1, usable.count()))
    chosen = usable.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    # At most about ``sample`` narrow rows, hence the broadcast.
    texts = docs.select(F.col("doc_id").cast("bigint").alias("id"), F.col("text").cast("string").alias("text"))
    rows = texts.join(F.broadcast(chosen), "id")
    kinds = {"buckets": pa.list_(pa.int32()), "counts": pa.list_(pa.float32())}

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [counted(t.as_py()) for t in batch.column("text")]
            columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate(kinds.values())]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("quality"), *columns], ["id", "quality", *kinds])

    def trained(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for batch in batches:
            lists = [[value.values.to_numpy() for value in batch.column(c)] for c in kinds]
            found.extend(zip(batch.column("id").to_pylist(), batch.column("quality").to_pylist(), *lists, strict=True))
        found.sort(key=lambda row: (row[0], row[1], len(row[2]), row[3].sum()))
        model = train([row[2:] for row in found], np.array([row[1] > 0 for row in found], float), **settings)
        parts = [model.vectors.astype("<f4").tobytes(), model.output.astype("<f8").tobytes(), model.bias.astype("<f8").tobytes()]
        yield pa.RecordBatch.from_arrays([pa.array([p], pa.binary()) for p in parts], ["vectors", "output", "bias"])

    hashed_rows = rows.mapInArrow(hashed, "id bigint, quality int, buckets array<int>, counts array<float>")
    # One row of a fixed size, whatever was learned from.
    model = hashed_rows.repartition(1).mapInArrow(trained, "vectors binary, output binary, bias binary").first()
    if model is None:
        return train([], np.zeros(0), **settings)
    output = np.frombuffer(model.output, "<f8").reshape(2, -1)
    return Embeddings(np.frombuffer(model.vectors, "<f4").reshape(BUCKETS, -1), output, np.frombuffer(model.bias, "<f8"))


def scores(docs: DataFrame, model: Embeddings, threshold: float = 0.3, held_out: int = 0) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``.

    Only the whole ``text`` decides a score. A null text, or one without a word,
    has the score of the bias alone. Repeated rows give repeated rows; an empty
    table gives an empty table; other columns are not read.
    """
    schema = "doc_id bigint, score double"

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.score(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.float64())], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(scored, schema)
    return rows.select(
        "doc_id",
        F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, model: Embeddings, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs``, with all their columns, that score at least the threshold."""

    def kept(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.string())
            yield batch.filter(pa.array([model.score(t.as_py()) >= threshold for t in texts], pa.bool_()))

    return docs.mapInArrow(kept, docs.schema)
