"""The load flows over tables of a few rows: what they return, and what they leave on disk."""

import os
from datetime import datetime
from uuid import uuid4

import pytest

from tributary_queries.tables import load_differential_flow, load_full_flow

DAY = datetime(2020, 1, 2)
TABLES = {
    "customer": ("c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string", [(n, f"customer {n}", n, 1.5, "BUILDING") for n in (1, 2)]),
    "supplier": ("s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double", [(7, "supplier", 3, -1.0)]),
    "part": ("p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double", [(5, "part", "brand", "PROMO", 6, 2.25)]),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
        [(1, 1, "O", 1.0, DAY, "1-URGENT"), (2, 1, "F", 1.0, DAY, "2-HIGH"), (3, 2, "F", 1.0, DAY, "1-URGENT")],
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double,"
        " l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
        [(order, 5, 7, 1, 3.0, 9.5, 0.05, 0.02, "R", "F", DAY) for order in (1, 2, 3)],
    ),
}


@pytest.fixture
def tables(spark, tmp_path, monkeypatch):
    """The folder of the tables; work folders lie beside it."""
    for name, (schema, rows) in TABLES.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/tables/{name}.parquet")
    for module in ("tributary_queries.tables", "tributary_queries.domain", "tributary.sources.archive"):
        monkeypatch.setattr(f"{module}.work_folder", lambda spark, purpose: f"{tmp_path}/work/{purpose}-{uuid4()}")
    return f"{tmp_path}/tables"


def left(tmp_path):
    return sorted(name.split("-")[0] for name in os.listdir(f"{tmp_path}/work"))


def test_a_differential_flow_leaves_tables_only(spark, tables, tmp_path):
    found = load_differential_flow(spark, tables).select("org_unit_id", "user_id", "role_name").collect()
    assert sorted(map(tuple, found)) == [(7, 1, "changed 2-HIGH"), (7, 2, "changed 1-URGENT")]
    assert left(tmp_path) == ["tables"]


def test_a_full_flow_leaves_tables_only(spark, tables, tmp_path):
    found = load_full_flow(spark, tables).groupBy("table_name").count().collect()
    assert {r["table_name"]: r["count"] for r in found} == {"users": 2, "org_units": 1, "grade_objects": 1, "grade_results": 2, "user_enrollments": 2}
    assert left(tmp_path) == ["tables"]
