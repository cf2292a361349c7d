"""The two published reports and their joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.functions.grades import grade


def with_user(facts: DataFrame, users: DataFrame, *columns) -> DataFrame:
    """Facts with columns of their user; facts without one are left out."""
    return facts.join(users.select("user_id", *columns), "user_id", "inner")


def with_org_unit(facts: DataFrame, org_units: DataFrame, *columns) -> DataFrame:
    """Facts with columns of their org unit; facts without one are left out."""
    return facts.join(org_units.select("org_unit_id", *columns), "org_unit_id", "inner")


def with_grade_object(facts: DataFrame, grade_objects: DataFrame, *columns) -> DataFrame:
    """Facts with columns of their grade object, matched by its id alone."""
    return facts.join(grade_objects.select("grade_object_id", *columns), "grade_object_id", "inner")


def grade_report(
    grade_results: DataFrame, users: DataFrame, org_units: DataFrame, grade_objects: DataFrame
) -> DataFrame:
    """Student, org unit, grade object and grade of every result."""
    facts = grade_results.select(
        "user_id",
        "org_unit_id",
        "grade_object_id",
        grade(F.col("points_numerator"), F.col("points_denominator")).alias("grade"),
    )
    facts = with_org_unit(facts, org_units, F.col("name").alias("org_unit_name"))
    facts = with_grade_object(facts, grade_objects, F.col("name").alias("grade_object_name"))
    facts = with_user(facts, users, F.col("user_name").alias("student_name"))
    return facts.select("student_name", "org_unit_name", "grade_object_name", "grade")


def enrollment_report(user_enrollments: DataFrame, users: DataFrame, org_units: DataFrame) -> DataFrame:
    """Name, role, org unit and date of every enrolment."""
    facts = user_enrollments.select(
        "user_id", "org_unit_id", F.col("role_name").alias("enrolled_role_name"), "enrollment_date"
    )
    facts = with_org_unit(facts, org_units, F.col("name").alias("org_unit_name"))
    facts = with_user(facts, users, "first_name", "last_name", "user_name")
    return facts.select(
        "first_name", "last_name", "user_name", "enrolled_role_name", "org_unit_name", "enrollment_date"
    )


def preview(report: DataFrame, rows: int = 50, ordered: bool = False) -> DataFrame:
    """Some rows of a report; the first ones by all columns if ``ordered``."""
    return (report.orderBy(*report.columns) if ordered else report).limit(rows)
