"""The five loadable tables and the registry of published data sets."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

LONG = T.LongType()
INT = T.IntegerType()
TEXT = T.StringType()
BOOL = T.BooleanType()
WHEN = T.TimestampNTZType()
# What the widest decimal holds with half of its digits after the point.
NUMBER = T.DecimalType(38, 18)

FULL = "full"
DIFFERENTIAL = "differential"


@dataclass(frozen=True)
class TableSpec:
    """Name, key and positional columns of a keyed table."""

    name: str
    keys: tuple[str, ...]
    schema: T.StructType

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def width(self) -> int:
        """Fields of an extract row past this number are ignored."""
        return len(self.schema.fields)

    def empty(self, spark: SparkSession) -> DataFrame:
        """An empty frame with the table's columns."""
        return spark.createDataFrame([], self.schema)


def table_spec(name: str, keys: list[str], columns: dict[str, T.DataType]) -> TableSpec:
    fields = [T.StructField(c, t, c not in keys) for c, t in columns.items()]
    return TableSpec(name, tuple(keys), T.StructType(fields))


# Names, order, types and keys of the published data sets.
ORG_UNITS = table_spec(
    "org_units",
    ["org_unit_id"],
    {
        "org_unit_id": LONG,
        "organization": TEXT,
        "type": TEXT,
        "name": TEXT,
        "code": TEXT,
        "start_date": WHEN,
        "end_date": WHEN,
        "is_active": BOOL,
        "created_date": WHEN,
    },
)
USERS = table_spec(
    "users",
    ["user_id"],
    {
        "user_id": LONG,
        "user_name": TEXT,
        "org_defined_id": TEXT,
        "first_name": TEXT,
        "middle_name": TEXT,
        "last_name": TEXT,
        "is_active": BOOL,
        "organization": TEXT,
        "internal_email": TEXT,
        "external_email": TEXT,
        "signup_date": WHEN,
    },
)
GRADE_OBJECTS = table_spec(
    "grade_objects",
    ["grade_object_id"],
    {
        "grade_object_id": LONG,
        "org_unit_id": LONG,
        "parent_grade_object_id": LONG,
        "name": TEXT,
        "type_name": TEXT,
        "category_name": TEXT,
        "start_date": WHEN,
        "end_date": WHEN,
        "is_auto_pointed": BOOL,
        "is_formula": BOOL,
        "is_bonus": BOOL,
        "max_points": NUMBER,
        "can_exceed_max_grade": BOOL,
        "exclude_from_final_grade_calc": BOOL,
        "grade_scheme_id": LONG,
        "weight": NUMBER,
        "num_lowest_grades_to_drop": INT,
        "num_highest_grades_to_drop": INT,
        "weight_distribution_type": TEXT,
        "created_date": WHEN,
        "tool_name": TEXT,
        "associated_tool_item_id": LONG,
        "last_modified": WHEN,
        "short_name": TEXT,
        "grade_object_type_id": INT,
        "sort_order": INT,
    },
)
GRADE_RESULTS = table_spec(
    "grade_results",
    ["grade_object_id", "org_unit_id", "user_id"],
    {
        "grade_object_id": LONG,
        "org_unit_id": LONG,
        "user_id": LONG,
        "points_numerator": NUMBER,
        "points_denominator": NUMBER,
        "weighted_numerator": NUMBER,
        "weighted_denominator": NUMBER,
        "is_released": BOOL,
        "is_dropped": BOOL,
        "last_modified": WHEN,
        "last_modified_by": LONG,
        "comments": TEXT,
        "private_comments": TEXT,
    },
)
USER_ENROLLMENTS = table_spec(
    "user_enrollments",
    ["org_unit_id", "user_id"],
    {
        "org_unit_id": LONG,
        "user_id": LONG,
        "role_name": TEXT,
        "enrollment_date": WHEN,
        "enrollment_type": TEXT,
    },
)

TABLES = {
    spec.name: spec
    for spec in (ORG_UNITS, USERS, GRADE_OBJECTS, GRADE_RESULTS, USER_ENROLLMENTS)
}

# Ids of the published data sets.
DATA_SETS = [
    ("07a9e561-e22f-4e82-8dd6-7bfb14c91776", "org_units", FULL),
    ("793668a8-2c58-4e5e-b263-412d28d5703f", "grade_objects", FULL),
    ("1d6d722e-b572-456f-97c1-d526570daa6b", "users", FULL),
    ("9d8a96b4-8145-416d-bd18-11402bc58f8d", "grade_results", FULL),
    ("533f84c8-b2ad-4688-94dc-c839952e9c4f", "user_enrollments", FULL),
    ("a78735f2-7210-4a57-aac1-e0f6bd714349", "user_enrollments", DIFFERENTIAL),
]


def registry(spark: SparkSession) -> DataFrame:
    """The known data sets as ``(plugin, table, mode)``."""
    return spark.createDataFrame(DATA_SETS, "plugin string, table string, mode string")
