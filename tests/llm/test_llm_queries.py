"""The registered queries over given tables, and the pipeline."""

import duckdb
import pytest

import corpus_pipeline
from tributary.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"
#: Queries that find nothing in the smallest tables.
LARGER = {"op13_collocations"}


def sql_rows(name):
    base = duckdb.connect()
    folder = "/root/testdata/sf0.01" if name in LARGER else FOLDER
    for table in ("documents", "embeddings", "pages", "labels"):
        base.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    result = base.execute(SQL[name])
    return [c[0] for c in result.description], result.fetchall()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_against_its_sql(spark, name):
    columns, wanted = sql_rows(name)
    found = QUERIES[name](spark, "/root/testdata/sf0.01" if name in LARGER else FOLDER)
    assert sorted(found.columns) == sorted(columns)
    assert sorted(map(str, map(tuple, found.select(*columns).collect()))) == sorted(map(str, wanted))
    assert wanted


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_returns_every_row(spark, name):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    found = QUERIES[name](spark, FOLDER)
    ids = found.select("doc_id").distinct().count()
    assert ids == rows and (name == "op6_best_fit_packing" or found.count() == rows)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    before = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, FOLDER), name)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == before and docs.count() > 0
    assert "sequence_id" in docs.columns and docs.count() > 0


def test_the_last_stage_returns_token_ids(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(20)
    found = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert found.where("ids IS NULL OR octet_length(ids) <> 4 * length").count() == 0 < found.count()
    assert "ids" not in QUERIES["op6_best_fit_packing"](spark, FOLDER).columns


def test_stages_take_empty_tables(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, FOLDER).count() == 0
