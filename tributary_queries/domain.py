"""The five tables shaped from the given ones, in Spark and as SQL."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.operators.upsert import last_wins
from tributary.schemas import NUMBER, TABLES
from tributary.storage import work_folder


def given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def moment(number: str, time: str = "10:11:12") -> str:
    """SQL of a time in January 2020 that goes with a number."""
    return f"CAST('2020-01-' || lpad(CAST({number} % 28 + 1 AS STRING), 2, '0') || ' {time}' AS {{time}})"


# Column and expression, the same in Spark's SQL and the other one's but for the
# name of the time type. Every column has values; most have NULLs.
COLUMNS = {
    "users": {
        "user_id": "c_custkey",
        "user_name": "c_name",
        "org_defined_id": "CAST(c_nationkey AS STRING)",
        "first_name": "c_mktsegment",
        "middle_name": "CASE WHEN c_custkey % 3 > 0 THEN substr(c_name, 10, 5) END",
        "last_name": "c_name",
        "is_active": "c_acctbal > 0",
        "organization": "CASE WHEN c_nationkey % 5 > 0 THEN 'nation, ' || CAST(c_nationkey AS STRING) END",
        "internal_email": "c_name || '@in.example'",
        "external_email": "CASE WHEN c_acctbal > 0 THEN 'x' || CAST(c_custkey AS STRING) || '@out.example' END",
        "signup_date": f"CASE WHEN c_custkey % 7 > 0 THEN {moment('c_custkey')} END",
    },
    "org_units": {
        "org_unit_id": "s_suppkey",
        "organization": "CASE WHEN s_nationkey % 5 > 0 THEN 'nation, ' || CAST(s_nationkey AS STRING) END",
        "type": "CASE WHEN s_suppkey % 4 > 0 THEN 'Course \"offering\"' END",
        "name": "s_name",
        "code": "CAST(s_nationkey AS STRING)",
        "start_date": moment("s_suppkey"),
        "end_date": f"CASE WHEN s_suppkey % 3 > 0 THEN {moment('s_suppkey', '23:59:59.5')} END",
        "is_active": "s_acctbal > 0",
        "created_date": f"CASE WHEN s_suppkey % 6 > 0 THEN {moment('s_nationkey', '00:00:00.123456')} END",
    },
    "grade_objects": {
        "grade_object_id": "p_partkey",
        "org_unit_id": "p_partkey % 10 + 1",
        "parent_grade_object_id": "CASE WHEN p_partkey % 4 > 0 THEN p_partkey - 1 END",
        "name": "p_name",
        "type_name": "p_type",
        "category_name": "p_brand",
        "start_date": f"CASE WHEN p_partkey % 5 > 0 THEN {moment('p_partkey')} END",
        "end_date": f"CASE WHEN p_partkey % 3 > 0 THEN {moment('p_size')} END",
        "is_auto_pointed": "p_size % 2 = 0",
        "is_formula": "CASE WHEN p_size % 3 > 0 THEN p_size % 5 = 0 END",
        "is_bonus": "p_size > 40",
        "max_points": "p_retailprice",
        "can_exceed_max_grade": "p_size % 7 = 0",
        "exclude_from_final_grade_calc": "CASE WHEN p_size % 4 > 0 THEN p_size % 3 = 0 END",
        "grade_scheme_id": "CASE WHEN p_size % 2 > 0 THEN CAST(p_size AS BIGINT) END",
        "weight": "CASE WHEN p_partkey % 6 > 0 THEN CAST(p_size AS DOUBLE) / 4 END",
        "num_lowest_grades_to_drop": "CAST(p_size % 3 AS INT)",
        "num_highest_grades_to_drop": "CASE WHEN p_size % 5 > 0 THEN CAST(p_size % 2 AS INT) END",
        "weight_distribution_type": "CASE WHEN p_size % 2 = 0 THEN 'Even' END",
        "created_date": moment("p_partkey", "01:02:03"),
        "tool_name": "CASE WHEN p_size % 6 > 0 THEN 'Tool' || CAST(p_size AS STRING) END",
        "associated_tool_item_id": "CASE WHEN p_size % 6 > 0 THEN p_partkey * 1000 END",
        "last_modified": f"CASE WHEN p_partkey % 8 > 0 THEN {moment('p_size', '04:05:06')} END",
        "short_name": "substr(p_name, 1, 4)",
        "grade_object_type_id": "CASE WHEN p_partkey % 9 > 0 THEN CAST(p_size % 9 AS INT) END",
        "sort_order": "p_size",
    },
    "grade_results": {
        "grade_object_id": "l_partkey",
        "org_unit_id": "l_suppkey",
        "user_id": "o_custkey",
        "points_numerator": "l_tax",
        "points_denominator": "l_discount",
        "weighted_numerator": "l_quantity",
        "weighted_denominator": "CASE WHEN l_linenumber % 5 > 0 THEN l_extendedprice END",
        "is_released": "l_linenumber % 2 = 0",
        "is_dropped": "CASE WHEN l_linenumber % 3 > 0 THEN l_returnflag = 'R' END",
        "last_modified": "l_shipdate",
        "last_modified_by": "CASE WHEN l_linenumber % 4 > 0 THEN o_custkey END",
        "comments": "CASE WHEN l_returnflag <> 'N' THEN 'flag, ' || l_returnflag END",
        "private_comments": "CASE WHEN l_linestatus = 'F' THEN o_orderpriority END",
    },
    "user_enrollments": {
        "org_unit_id": "l_suppkey",
        "user_id": "o_custkey",
        "role_name": "o_orderpriority",
        "enrollment_date": "o_orderdate",
        "enrollment_type": "CASE WHEN l_linenumber % 3 > 0 THEN o_orderstatus END",
    },
}


def shaped(table: str, time: str) -> list[str]:
    return [f"{expression.format(time=time)} AS {name}" for name, expression in COLUMNS[table].items()]


def selected(rows: DataFrame, table: str, *more: str) -> DataFrame:
    """The table's columns with its types, and ``more`` columns of ``rows``."""
    picked = rows.selectExpr(*shaped(table, "TIMESTAMP_NTZ"), *more)
    return picked.withColumns({f.name: F.col(f.name).cast(f.dataType) for f in TABLES[table].schema.fields})


def users(spark, sf_dir):
    return selected(given(spark, sf_dir, "customer"), "users")


def org_units(spark, sf_dir):
    return selected(given(spark, sf_dir, "supplier"), "org_units")


def grade_objects(spark, sf_dir):
    return selected(given(spark, sf_dir, "part"), "grade_objects")


def ordered_lines(spark, sf_dir):
    orders = given(spark, sf_dir, "orders")
    return given(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def last_lines(spark, sf_dir, table, position):
    """The table's rows of the last lines.

    Lines are compared as they are given, without the columns that the table does
    not need, and shaped when one is left per key: they are narrower then, and
    fewer.
    """
    keys = [COLUMNS[table][k] for k in TABLES[table].keys]
    named = set(re.findall(r"[lo]_[a-z]+", " ".join(COLUMNS[table].values()))) - {*keys, *position}
    lines = ordered_lines(spark, sf_dir).select(*keys, *position, *sorted(named))
    return selected(last_wins(lines, keys, position), table)


def grade_results(spark, sf_dir):
    """The last line of each part, supplier and customer."""
    return last_lines(spark, sf_dir, "grade_results", ["l_orderkey", "l_linenumber", "l_extendedprice"])


def user_enrollments(spark, sf_dir):
    """The last order of each supplier and customer."""
    return last_lines(spark, sf_dir, "user_enrollments", ["l_orderkey", "l_linenumber", "l_partkey"])


DOMAIN = {
    "org_units": org_units,
    "users": users,
    "grade_objects": grade_objects,
    "grade_results": grade_results,
    "user_enrollments": user_enrollments,
}


# Joined and deduped, so worth storing where they are read several times.
DERIVED = ("grade_results", "user_enrollments")


def stored(rows: DataFrame, path: str | None = None) -> DataFrame:
    """The same rows, written once where they are read several times."""
    path = path or work_folder(rows.sparkSession, "stored")
    rows.write.parquet(path, compression="zstd")
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def plain(rows: DataFrame) -> DataFrame:
    """Decimals as doubles, the type of the given tables."""
    decimals = [f.name for f in rows.schema.fields if isinstance(f.dataType, T.DecimalType)]
    return rows.withColumns({c: F.col(c).cast("double") for c in decimals})


def extract_schema(rows: DataFrame) -> T.StructType:
    """The loader's types for a given table: its doubles are decimals."""
    return T.StructType(
        [
            T.StructField(f.name, NUMBER if isinstance(f.dataType, T.DoubleType) else f.dataType)
            for f in rows.schema.fields
        ]
    )


def _plain_sql(table: str, source: str) -> str:
    return f"SELECT {', '.join(shaped(table, 'TIMESTAMP'))} FROM {source}"


def _last_sql(table: str, keys: str, position: str) -> str:
    return f"""
        SELECT {", ".join(COLUMNS[table])}
        FROM (SELECT {", ".join(shaped(table, "TIMESTAMP"))},
                     ROW_NUMBER() OVER (PARTITION BY {keys} ORDER BY {position}) AS rn
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey) x
        WHERE rn = 1"""


SQL = {
    "users": _plain_sql("users", "customer"),
    "org_units": _plain_sql("org_units", "supplier"),
    "grade_objects": _plain_sql("grade_objects", "part"),
    "grade_results": _last_sql(
        "grade_results", "l_partkey, l_suppkey, o_custkey", "l_orderkey DESC, l_linenumber DESC, l_extendedprice DESC"
    ),
    "user_enrollments": _last_sql(
        "user_enrollments", "l_suppkey, o_custkey", "l_orderkey DESC, l_linenumber DESC, l_partkey DESC"
    ),
}
