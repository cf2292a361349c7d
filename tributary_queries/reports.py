"""Queries of the reports: their joins, expressions and previews."""

from __future__ import annotations

from pyspark.sql import functions as F

from tributary.functions.grades import grade, ratio, zero_guarded
from tributary.plans import reports
from tributary.schemas import NUMBER
from tributary_queries import domain
from tributary_queries.domain import given, plain


def join_users(spark, sf_dir):
    """Enrolments of active users: facts of the others have no partner."""
    facts = domain.user_enrollments(spark, sf_dir)
    users = domain.users(spark, sf_dir).where("is_active")
    return reports.with_user(facts, users, "user_name").select("org_unit_id", "user_id", "user_name")


def join_org_units(spark, sf_dir):
    facts = domain.user_enrollments(spark, sf_dir)
    units = domain.org_units(spark, sf_dir).where("is_active")
    return reports.with_org_unit(facts, units, "name").select("org_unit_id", "user_id", "name")


def join_grade_objects(spark, sf_dir):
    facts = domain.grade_results(spark, sf_dir)
    objects = domain.grade_objects(spark, sf_dir).where("type_name <> 'PROMO'")
    columns = ["grade_object_id", "org_unit_id", "user_id", "name"]
    return reports.with_grade_object(facts, objects, "name").select(*columns)


def _lines(spark, sf_dir):
    """Every line with its tax as numerator and its discount as denominator."""
    return given(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        F.col("l_tax").cast(NUMBER).alias("n"),
        F.col("l_discount").cast(NUMBER).alias("d"),
    )


def _with(rows, value):
    return plain(rows.select("l_orderkey", "l_partkey", "l_suppkey", value))


def case_zero_guard(spark, sf_dir):
    """Zero where the discount is zero, the tax elsewhere; NULL discounts give NULL."""
    rows = _lines(spark, sf_dir)
    d = F.nullif(F.col("d"), F.lit(0.1).cast(NUMBER))
    guarded = zero_guarded(d, F.when(d.isNotNull(), F.col("n")))
    return _with(rows, guarded.cast("double").alias("guarded"))


def decimal_ratio(spark, sf_dir):
    """Lines without a discount have no ratio."""
    n, d = (F.col(c).cast("decimal(20,9)") for c in "nd")
    return _with(_lines(spark, sf_dir), F.when(d != 0, F.round(ratio(n, d), 9)).alias("ratio"))


def round_half_up(spark, sf_dir):
    return _with(_lines(spark, sf_dir), grade(F.col("n"), F.col("d")).alias("grade"))


def round_half_wide(spark, sf_dir):
    """Denominators of 18 digits; every second quotient lies 1e-18 of its numerator below a half."""
    lines = given(spark, sf_dir, "lineitem")
    unit = F.lit(10**15) + F.col("l_orderkey")
    odd = F.col("l_linenumber") * 2 + 1
    exact = (unit.cast("decimal(18,0)") * odd.cast("decimal(3,0)")).cast("decimal(20,0)")
    under = F.concat((exact - F.lit(1)).cast("string"), F.lit(".999999999999999999"))
    n = F.when(F.col("l_suppkey") % 2 == 0, under).otherwise(exact.cast("string"))
    wide = lines.select("l_orderkey", "l_partkey", "l_suppkey", n.cast(NUMBER).alias("n"), (unit * 200).cast(NUMBER).alias("d"))
    return _with(wide, grade(F.col("n"), F.col("d")).alias("grade"))


def grade_report(spark, sf_dir):
    report = reports.grade_report(
        domain.grade_results(spark, sf_dir),
        domain.users(spark, sf_dir),
        domain.org_units(spark, sf_dir),
        domain.grade_objects(spark, sf_dir),
    )
    return plain(report)


def enrollment_report(spark, sf_dir):
    return reports.enrollment_report(
        domain.user_enrollments(spark, sf_dir), domain.users(spark, sf_dir), domain.org_units(spark, sf_dir)
    )


def report_preview(spark, sf_dir):
    return reports.preview(grade_report(spark, sf_dir), ordered=True)


QUERIES = {
    "join_users": join_users,
    "join_org_units": join_org_units,
    "join_grade_objects": join_grade_objects,
    "case_zero_guard": case_zero_guard,
    "decimal_ratio": decimal_ratio,
    "round_half_up": round_half_up,
    "round_half_wide": round_half_wide,
    "grade_report": grade_report,
    "enrollment_report": enrollment_report,
    "report_preview": report_preview,
}

_KEYS = "l_orderkey, l_partkey, l_suppkey"
# The same ratio from whole hundredths, rounded half up in integers.
_HUNDREDTHS = f"""
    SELECT {_KEYS}, CAST(round(l_tax * 100) AS BIGINT) AS t, CAST(round(l_discount * 100) AS BIGINT) AS d
    FROM lineitem"""
_GRADE = f"""
    SELECT u.user_name AS student_name, ou.name AS org_unit_name, o.name AS grade_object_name,
           CASE WHEN gr.points_denominator = 0 THEN 0
                ELSE ((200 * CAST(round(gr.points_numerator * 100) AS BIGINT)
                       + CAST(round(gr.points_denominator * 100) AS BIGINT))
                      // (2 * CAST(round(gr.points_denominator * 100) AS BIGINT))) / 100.0 END AS grade
    FROM ({domain.SQL["grade_results"]}) gr
    JOIN ({domain.SQL["users"]}) u ON gr.user_id = u.user_id
    JOIN ({domain.SQL["org_units"]}) ou ON gr.org_unit_id = ou.org_unit_id
    JOIN ({domain.SQL["grade_objects"]}) o ON gr.grade_object_id = o.grade_object_id"""

SQL = {
    "join_users": f"""
        SELECT f.org_unit_id, f.user_id, u.user_name
        FROM ({domain.SQL["user_enrollments"]}) f
        JOIN ({domain.SQL["users"]}) u ON f.user_id = u.user_id WHERE u.is_active""",
    "join_org_units": f"""
        SELECT f.org_unit_id, f.user_id, u.name
        FROM ({domain.SQL["user_enrollments"]}) f
        JOIN ({domain.SQL["org_units"]}) u ON f.org_unit_id = u.org_unit_id WHERE u.is_active""",
    "join_grade_objects": f"""
        SELECT f.grade_object_id, f.org_unit_id, f.user_id, o.name
        FROM ({domain.SQL["grade_results"]}) f
        JOIN ({domain.SQL["grade_objects"]}) o ON f.grade_object_id = o.grade_object_id
        WHERE o.type_name <> 'PROMO'""",
    "case_zero_guard": f"""
        SELECT {_KEYS},
               CASE WHEN l_discount = 0 THEN 0.0 WHEN l_discount = 0.1 THEN NULL ELSE l_tax END AS guarded
        FROM lineitem""",
    "decimal_ratio": f"""
        SELECT {_KEYS}, CASE WHEN d <> 0 THEN round(CAST(t AS DOUBLE) / d, 9) END AS ratio FROM ({_HUNDREDTHS}) x""",
    "round_half_up": f"""
        SELECT {_KEYS}, CAST(CASE WHEN d = 0 THEN 0 ELSE ((200 * t + d) // (2 * d)) / 100.0 END AS DOUBLE) AS grade
        FROM ({_HUNDREDTHS}) x""",
    # Numerators and denominators in units of 1e-18, rounded half up in integers.
    "round_half_wide": f"""
        SELECT {_KEYS}, CAST((200 * n + d) // (2 * d) AS DOUBLE) / 100 AS grade
        FROM (SELECT {_KEYS}, CAST(1000000000000000 + l_orderkey AS HUGEINT) * (2 * l_linenumber + 1) * 1000000000000000000
                     - CASE WHEN l_suppkey % 2 = 0 THEN 1 ELSE 0 END AS n,
                     CAST(1000000000000000 + l_orderkey AS HUGEINT) * 200 * 1000000000000000000 AS d
              FROM lineitem) x""",
    "grade_report": f"""
        SELECT student_name, org_unit_name, grade_object_name, CAST(grade AS DOUBLE) AS grade FROM ({_GRADE}) r""",
    "enrollment_report": f"""
        SELECT u.first_name, u.last_name, u.user_name, ue.role_name AS enrolled_role_name,
               ou.name AS org_unit_name, ue.enrollment_date
        FROM ({domain.SQL["user_enrollments"]}) ue
        JOIN ({domain.SQL["users"]}) u ON ue.user_id = u.user_id
        JOIN ({domain.SQL["org_units"]}) ou ON ue.org_unit_id = ou.org_unit_id""",
    "report_preview": f"""
        SELECT student_name, org_unit_name, grade_object_name, CAST(grade AS DOUBLE) AS grade FROM ({_GRADE}) r
        ORDER BY student_name, org_unit_name, grade_object_name, grade LIMIT 50""",
}
