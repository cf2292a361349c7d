"""Plans: what is read, what is shuffled, what is broadcast."""

import pytest
from pyspark.sql import functions as F

from tests.helpers import plan, settings
from tributary.operators.upsert import without_keys
from tributary.plans import reports
from tributary_queries import domain

SF_DIR = "/root/testdata/sf0.001"
NO_BROADCAST = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("domain")
    for name, rows in domain.DOMAIN.items():
        rows(spark, SF_DIR).write.parquet(f"{folder}/{name}")
    return {name: spark.read.parquet(f"{folder}/{name}") for name in domain.DOMAIN}


def grades(t):
    return reports.grade_report(t["grade_results"], t["users"], t["org_units"], t["grade_objects"])


def test_reports_read_only_the_columns_they_use(stored):
    text = plan(grades(stored))
    assert "ReadSchema: struct<user_id:bigint,user_name:string>" in text
    assert "ReadSchema: struct<org_unit_id:bigint,name:string>" in text
    assert "ReadSchema: struct<grade_object_id:bigint,name:string>" in text
    assert "last_modified" not in text and "max_points" not in text
    assert "IsNotNull(user_id)" in text


def test_small_dimensions_leave_the_facts_where_they_are(stored):
    text = plan(grades(stored), "simple")
    assert text.count("BroadcastHashJoin") == 3 and "hashpartitioning" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_large_dimensions_are_merge_joined(spark, stored):
    with settings(spark, **NO_BROADCAST):
        text = plan(grades(stored), "simple")
    assert text.count("SortMergeJoin") == 3 and "Broadcast" not in text and "CartesianProduct" not in text


def test_preview_is_a_top_k(stored):
    assert "TakeOrderedAndProject" in plan(reports.preview(grades(stored), ordered=True), "simple")
    assert "CollectLimit" in plan(reports.preview(grades(stored)), "simple")


def test_small_delta_leaves_the_base_where_it_is(stored):
    base = stored["user_enrollments"]
    text = plan(without_keys(base, base.where("role_name = '1-URGENT'"), ["org_unit_id", "user_id"]), "simple")
    assert "LeftAnti" in text and "BroadcastHashJoin" in text and "hashpartitioning" not in text


def test_a_hot_key_is_split_in_the_joins(spark, stored):
    """A third of all facts on one user: the merge join splits that partition."""
    facts = spark.range(0, 3_000_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 997).alias("user_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    users = spark.range(1000).select(F.col("id").alias("user_id"), F.col("id").cast("string").alias("user_name"))
    limits = {
        "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "1MB",
        "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
        "spark__sql__adaptive__advisoryPartitionSizeInBytes": "4MB",
    }
    with settings(spark, **NO_BROADCAST, **limits):
        joined = reports.with_user(facts, users, "user_name")
        kept = joined.agg(F.count("payload").alias("n"), F.sum("user_id").alias("s"))
        assert kept.collect()[0]["n"] == 3_000_000
        assert "skew" in kept._jdf.queryExecution().executedPlan().toString()


def test_lines_are_shaped_when_one_is_left_per_key(spark):
    """What is shuffled are the columns as given: no decimals, no columns the table does not need."""
    text = plan(domain.grade_results(spark, SF_DIR), "simple")
    below = text.split("hashpartitioning")[-1]
    assert "decimal" not in below and "o_totalprice" not in below and "decimal(38,18)" in text
