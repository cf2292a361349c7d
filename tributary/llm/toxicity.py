"""Toxicity scores by a factorization machine over hashed terms."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import training_side

LETTERS = re.compile(r"[^\W\d_]+")
#: Terms are whole words and, of longer words, their beginnings.
STEM = 6
HASH_BITS = 22
MASK = (1 << HASH_BITS) - 1


def terms(text: str | None) -> list[int]:
    """Hashes of the distinct terms of a whole text."""
    found = set()
    for word in set(LETTERS.findall((text or "").lower())):
        raw = word.encode()
        found.add(zlib.crc32(raw) & MASK)
        if len(word) > STEM:
            found.add(zlib.crc32(word[:STEM].encode(), 1) & MASK)
    return sorted(found)


@dataclass
class Machine:
    """Bias, weight and factor vector per known term."""

    bias: float
    known: np.ndarray
    weights: np.ndarray
    factors: np.ndarray

    def margin(self, found: list[int]) -> float:
        """Bias, weights of the terms present and the products of their pairs."""
        if not len(self.known) or not len(found):
            return self.bias
        at = np.searchsorted(self.known, found)
        at = at[self.known[np.minimum(at, len(self.known) - 1)] == found]
        v = self.factors[at]
        pairs = 0.5 * float((v.sum(0) ** 2 - (v**2).sum(0)).sum())
        return self.bias + float(self.weights[at].sum()) + pairs

    def score(self, found: list[int]) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.margin(found), -30, 30))))


def select(rows: list[np.ndarray], toxic: np.ndarray, features: int, least_gain: float) -> np.ndarray:
    """The terms whose presence tells most about the label, by the G statistic.

    Terms that gain less than ``least_gain`` (half of G) are as good as noise.
    """
    every = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    marks = np.repeat(toxic, [len(r) for r in rows])
    seen = np.bincount(every, minlength=1)
    bad = np.bincount(every, weights=marks, minlength=1)
    n, n_bad = len(toxic), toxic.sum()

    def part(observed, expected):
        return np.where(observed > 0, observed * np.log(np.maximum(observed, 1e-12) / np.maximum(expected, 1e-12)), 0)

    good, rate = seen - bad, n_bad / n
    gain = part(bad, seen * rate) + part(good, seen * (1 - rate))
    gain += part(n_bad - bad, (n - seen) * rate) + part(n - n_bad - good, (n - seen) * (1 - rate))
    best = np.argsort(-gain, kind="stable")[:features]
    return np.sort(best[gain[best] > least_gain])


def train(
    rows: list[np.ndarray],
    toxic: np.ndarray,
    features: int = 2048,
    rank: int = 8,
    rounds: int = 150,
    rate: float = 0.05,
    decay: float = 2e-4,
    least_gain: float = 6.0,
) -> Machine:
    """Fit by full gradients (Adam). One class alone gives its smoothed rate."""
    base = (toxic.sum() + 0.5) / (len(toxic) + 1) if len(toxic) else 1e-3
    bias = float(np.log(base / (1 - base)))
    known = select(rows, toxic, features, least_gain) if 0 < toxic.sum() < len(toxic) else np.zeros(0, np.int64)
    if not len(known):
        return Machine(bias, known, np.zeros(0), np.zeros((0, rank)))
    inside = [np.flatnonzero(np.isin(known, r, assume_unique=True)) for r in rows]
    of = np.repeat(np.arange(len(rows)), [len(r) for r in inside])
    term = np.concatenate(inside)
    values = np.random.default_rng(0).normal(0, 0.03, (len(known), rank + 1))
    values[:, 0] = 0
    first, second = np.zeros_like(values), np.zeros_like(values)

    def per_row(x):
        return np.bincount(of, weights=x, minlength=len(rows))

    def per_term(x):
        return np.bincount(term, weights=x, minlength=len(known))

    for step in range(1, rounds + 1):
        at = values[term]
        sums = np.stack([per_row(at[:, f]) for f in range(1, rank + 1)], 1)
        squares = per_row((at[:, 1:] ** 2).sum(1))
        margin = bias + per_row(at[:, 0]) + 0.5 * ((sums**2).sum(1) - squares)
        error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - toxic) / len(rows)
        gradient = np.empty_like(values)
        gradient[:, 0] = per_term(error[of])
        for f in range(rank):
            gradient[:, f + 1] = per_term(error[of] * (sums[of, f] - at[:, f + 1]))
        gradient += decay * values
        bias -= rate * float(error.sum())
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        values -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Machine(bias, known, values[:, 0].copy(), values[:, 1:].copy())


def fit(docs: DataFrame, labels: DataFrame, sample: int = 12000, held_out: int = 2, **settings) -> Machine:
    """A machine fitted on about ``sample`` labelled rows, chosen by hash of the id.

    Rows whose crc32 of the id mod 4 is ``held_out`` are never used. ``sample``
    bounds what one task trains on; the texts of the sample are read whole. Of
    several labels of one id the highest counts; null labels and ids are left out.
    """
    usable = labels.select(F.col("doc_id").cast("bigint").alias("id"), F.col("toxic").cast("int").alias("toxic"))
    usable = usable.where(training_side(F.col("id"), held_out)).where("toxic IS NOT NULL")
    usable = usable.groupBy("id").agg(F.max("toxic").alias("toxic"))
    share = min(1.0, sample / max(1, usable.count()))
    chosen = usable.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    # At most about ``sample`` narrow rows, hence the broadcast.
    texts = docs.select(F.col("doc_id").cast("bigint").alias("id"), F.col("text").cast("string").alias("text"))
    rows = texts.join(F.broadcast(chosen), "id")

    def termed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [terms(t.as_py()) for t in batch.column("text")]
            columns = [batch.column("id"), batch.column("toxic"), pa.array(found, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "toxic", "terms"])

    def trained(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, toxic, found = [], [], []
        for batch in batches:
            ids.extend(batch.column("id").to_pylist())
            toxic.extend(batch.column("toxic").to_pylist())
            found.extend(np.asarray(x.values, np.int64) for x in batch.column("terms"))
        order = sorted(range(len(ids)), key=lambda i: (ids[i], toxic[i], len(found[i])))
        model = train([found[i] for i in order], np.array([toxic[i] > 0 for i in order], float), **settings)
        values = np.concatenate([[[-1, model.bias]], np.stack([model.known, model.weights], 1)]) if len(model.known) else np.array([[-1, model.bias]])
        factors = [[]] + [list(map(float, v)) for v in model.factors]
        yield pa.RecordBatch.from_arrays(
            [pa.array(values[:, 0].astype(np.int64)), pa.array(values[:, 1]), pa.array(factors, pa.list_(pa.float64()))],
            ["term", "weight", "factors"],
        )

    sampled = rows.mapInArrow(termed, "id bigint, toxic int, terms array<int>").repartition(1)
    model = sampled.mapInArrow(trained, "term bigint, weight double, factors array<double>").collect()
    known = sorted((r.term, r.weight, r.factors) for r in model if r.term >= 0)
    return Machine(
        next((r.weight for r in model if r.term < 0), -7.0),
        np.array([k[0] for k in known], np.int64),
        np.array([k[1] for k in known]),
        np.array([k[2] for k in known]) if known else np.zeros((0, 1)),
    )


def scores(docs: DataFrame, machine: Machine, threshold: float = 0.3, held_out: int = 2) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``.

    Only ``text`` decides a score. A null or empty text, or one without a known
    term, has the score of the bias alone. Repeated rows give repeated rows.
    """
    schema = "doc_id bigint, score double"

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [machine.score(terms(t.as_py())) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.float64())], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(scored, schema)
    return rows.select(
        "doc_id",
        F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_clean(docs: DataFrame, machine: Machine, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs``, with all their columns, that score below the threshold."""

    def kept(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.string())
            mask = [machine.score(terms(t.as_py())) < threshold for t in texts]
            yield batch.filter(pa.array(mask, pa.bool_()))

    return docs.mapInArrow(kept, docs.schema)
