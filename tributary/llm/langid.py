"""Language identification by the nearest of several centroids per language."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import stored, training_side

#: Hashed n-grams of one to three characters.
BUCKETS = 1 << 13
SHIFT = np.uint32(32 - 13)
MIX = np.uint32(2654435761)
LETTERS = re.compile(r"[^\W\d_]+")
#: A cluster of less than this share of its language is taken for mislabelled texts.
LEAST_SHARE = 0.05
#: Characters counted at once; longer texts are counted in pieces.
PIECE = 1 << 18


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def counts(text: str) -> np.ndarray:
    """Counts of a whole text's n-grams by bucket: of its words of letters, case ignored."""
    found = np.zeros(BUCKETS, np.float32)
    points = np.frombuffer((" " + " ".join(LETTERS.findall(text.lower())) + " ").encode("utf-32-le", "replace"), np.uint32)
    for start in range(0, len(points), PIECE):
        one = points[start : start + PIECE + 2]
        last = min(PIECE, len(points) - start)
        two = one[:-1] * np.uint32(0x9E3779B1) + one[1:]
        three = two[:-1] * np.uint32(0x85EBCA77) + one[2:]
        for grams, salt in ((one, 1), (two, 2), (three, 3)):
            grams = grams[:last]
            mixed = (grams ^ (grams >> np.uint32(15))) * MIX + np.uint32(salt * 0x27D4EB2F)
            mixed = (mixed ^ (mixed >> np.uint32(13))) * MIX
            found += np.bincount(mixed >> SHIFT, minlength=BUCKETS)
    return found


def weighted(found: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF of length one; all zero if there is nothing."""
    vector = np.log1p(found) * idf
    length = np.linalg.norm(vector)
    return vector / length if length else vector


def cluster(vectors: np.ndarray, centroids: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means from rows drawn with a fixed seed; small clusters are left out."""
    drawn = np.random.default_rng(0).choice(len(vectors), min(centroids, len(vectors)), replace=False)
    centres = vectors[np.sort(drawn)]
    for _ in range(rounds):
        nearest = (vectors @ centres.T).argmax(1)
        sums = [vectors[nearest == k].sum(0) if (nearest == k).any() else centres[k] for k in range(len(centres))]
        centres = np.stack([s / max(np.linalg.norm(s), 1e-12) for s in sums])
    sizes = np.bincount((vectors @ centres.T).argmax(1), minlength=len(centres))
    return centres[sizes >= min(LEAST_SHARE * len(vectors), sizes.max())].astype(np.float32)


@dataclass
class Centroids:
    """Languages with their centroids, and the distance from which all are too far."""

    languages: list[str]
    centres: np.ndarray
    idf: np.ndarray
    farthest: float

    def nearest(self, text: str) -> tuple[str, float, bool]:
        """Language, cosine, and whether it is rejected as too far."""
        if not self.languages:
            return "und", 0.0, True
        near = self.centres @ weighted(counts(text), self.idf)
        best = int(near.argmax())
        cosine = float(min(1.0, max(0.0, near[best])))
        return self.languages[best], cosine, 1 - cosine > self.farthest


def fit(
    docs: DataFrame, sample: int = 600, centroids: int = 4, held_out: int = 2, reject_share: float = 0.001
) -> Centroids:
    """Centroids from about ``sample`` whole texts of each language, chosen by hash of the id.

    Rows whose crc32 of the id mod 4 is ``held_out``, and rows with a null
    language, id or text or without a letter, are not used. The n-grams' weights
    come from the same sample. The distance at which the share ``reject_share``
    of a language's own sample would be rejected, plus a tenth, is the limit.
    """
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")
    )
    rows = rows.where(training_side(F.col("id"), held_out) & F.col("lang").isNotNull())
    shares = rows.groupBy("lang").agg((F.lit(float(sample)) / F.count("*")).alias("share"))
    dice = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # The ids alone are joined and stored; the few that are left pick the texts.
    ids = stored(rows.select("id", "lang").join(shares, "lang").where(dice < F.col("share")).select("id").distinct(), "sample")
    chosen = rows.where("text IS NOT NULL").join(ids, "id", "left_semi").select("id", "lang", "text")

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.float32())]
        for batch in batches:
            texts = batch.column("text")
            use = [i for i, t in enumerate(texts) if has_letter(t.as_py())]
            vectors = [counts(texts[i].as_py()) for i in use]
            places = [np.flatnonzero(v).astype(np.int32) for v in vectors]
            values = [
                batch.column("id").take(use),
                batch.column("lang").take(use),
                pa.array(places, kinds[2]),
                pa.array([v[p] for v, p in zip(vectors, places, strict=True)], kinds[3]),
            ]
            yield pa.RecordBatch.from_arrays(values, ["id", "lang", "places", "counts"])

    vectors = chosen.mapInArrow(counted, "id bigint, lang string, places array<int>, counts array<float>")

    def summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One language's sample is bounded, so its vectors fit into one task.
        by_lang: dict[str, list] = {}
        for batch in batches:
            for row in batch.to_pylist():
                by_lang.setdefault(row["lang"], []).append((row["id"], row["places"], row["counts"]))
        for lang, found in sorted(by_lang.items()):
            dense = np.zeros((len(found), BUCKETS), np.float32)
            for i, (_, places, values) in enumerate(sorted(found)):
                dense[i, places] = values
            seen = (dense > 0).sum(0).astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang]), pa.array([len(found)], pa.int64()), pa.array([seen]), pa.array([_packed(dense)], pa.binary())],
                ["lang", "docs", "seen", "vectors"],
            )

    by_lang = vectors.repartition("lang").mapInArrow(summed, "lang string, docs bigint, seen array<double>, vectors binary")
    by_lang = stored(by_lang, "languages")
    totals = by_lang.select("docs", "seen").collect()
    docs_in_all = sum(r.docs for r in totals)
    seen = np.sum([r.seen for r in totals], axis=0) if totals else np.zeros(BUCKETS)
    idf = (np.log((1 + docs_in_all) / (1 + seen)) + 1).astype(np.float32)

    def clustered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                dense = np.stack([weighted(v, idf) for v in _unpacked(row["vectors"], row["docs"])])
                centres = cluster(dense, centroids)
                far = 1 - (dense @ centres.T).max(1)
                values = [pa.array([row["lang"]]), pa.array([centres.tobytes()], pa.binary()), pa.array([float(np.quantile(far, 1 - reject_share))])]
                yield pa.RecordBatch.from_arrays(values, ["lang", "centres", "far"])

    found = sorted(by_lang.mapInArrow(clustered, "lang string, centres binary, far double").collect(), key=lambda r: r.lang)
    centres = [np.frombuffer(r.centres, np.float32).reshape(-1, BUCKETS) for r in found]
    names = [r.lang for r, c in zip(found, centres, strict=True) for _ in c]
    every = np.concatenate(centres) if centres else np.zeros((0, BUCKETS), np.float32)
    return Centroids(names, every, idf, max((r.far for r in found), default=1.0) + 0.1)


def _packed(dense: np.ndarray) -> bytes:
    return zlib.compress(dense.tobytes(), 1)


def _unpacked(raw: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(zlib.decompress(raw), np.float32).reshape(rows, BUCKETS)


def identify(docs: DataFrame, model: Centroids, held_out: int = 2) -> DataFrame:
    """Language of every row of ``docs`` by its whole text.

    Returns ``doc_id, held_out, lang_pred, score`` (the cosine, 0 to 1),
    ``rejected`` (farther than the model's limit from every centroid) and
    ``lang``, which is null where rejected. A null text or one without a letter
    is ``und``, score 0, rejected; so is every text if nothing could be learned.
    """
    schema = "doc_id bigint, lang_pred string, score double, rejected boolean"

    def named(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (value.as_py() or "" for value in batch.column("text"))
            found = [model.nearest(t) if has_letter(t) else ("und", 0.0, True) for t in texts]
            langs, scores, far = zip(*found, strict=True) if found else ((), (), ())
            columns = [batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(far, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score", "rejected"])

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(named, schema)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == held_out, F.lit(False))
    return rows.select(
        "doc_id", held.alias("held_out"), "lang_pred", "score", "rejected", F.when(~F.col("rejected"), F.col("lang_pred")).alias("lang")
    )
