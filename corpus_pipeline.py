"""From raw documents to packed sequences, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and returns a frame; ``run`` writes it
as Parquet to the shared folder and reads it again as the next stage's ``docs``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tributary.llm import mixing, packing, pii, simhash, toxicity
from tributary.llm.common import stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; labels are joined to ``docs`` itself."""
    machine = toxicity.fit(docs, table(spark, sf_dir, "labels"), sample=12000)
    return toxicity.keep_clean(docs, machine, threshold=0.3)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.one_of_each(docs, shingle_words=4, max_bits=4)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.repeat(docs, weights=(1, 2, 3), most=3)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents in pieces with their places in sequences."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), size=2048)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("pii", redact_personal_data),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: Training, fingerprints, Newton rounds and tokenizers are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
