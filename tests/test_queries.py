"""Every registered query against its SQL, row for row."""

import importlib
from collections import Counter

import duckdb
import pytest

from tributary.schemas import TABLES
from tributary_queries import extracts, reports, tables
from tributary_queries.domain import DOMAIN

entry = importlib.import_module("__spark_entry__")
SF_DIR = "/root/testdata/sf0.001"
GIVEN = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in GIVEN:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield connection
    connection.close()


OWN = {**extracts.QUERIES, **tables.QUERIES, **reports.QUERIES}


def test_every_query_has_its_sql():
    assert set(OWN) <= set(entry.queries()) and set(OWN) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(OWN))
def test_query_matches_its_sql(spark, oracle, name):
    frame = entry.queries()[name](spark, SF_DIR)
    columns = sorted(frame.columns)
    found = Counter(tuple(r) for r in frame.select(*columns).collect())
    listed = ", ".join(f'"{c}"' for c in columns)
    wanted = Counter(oracle.execute(f"SELECT {listed} FROM ({entry.oracle_sql()[name]}) q").fetchall())
    assert found == wanted
    assert sum(found.values()) > 0


def test_entry_runs(spark):
    frame = entry.entry(spark)
    assert frame.columns == ["student_name", "org_unit_name", "grade_object_name", "grade"]
    assert frame.count() > 0


def test_the_pending_query_reads_pending_deltas(spark):
    table = tables.users_with_pending(spark, SF_DIR)
    assert len(table.state().deltas) == 2
    table.fold()
    assert table.state().deltas == ()


def test_every_column_has_values(spark):
    for name, rows in DOMAIN.items():
        frame = rows(spark, SF_DIR)
        assert frame.columns == TABLES[name].columns
        filled = frame.selectExpr(*[f"count({c}) AS {c}" for c in frame.columns]).first()
        assert all(filled[c] > 0 for c in frame.columns), name
