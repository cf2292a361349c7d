"""Key checks: Spark tables declare no keys, so these stand in for them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def any_null(keys):
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def null_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with a NULL in the key."""
    return rows.where(any_null(keys))


def duplicate_keys(rows: DataFrame, keys: list[str], count_name: str = "n") -> DataFrame:
    """Keys held by more than one row, with the number of rows."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name)).where(F.col(count_name) > 1)


def null_key_reason(keys: list[str]):
    """What is wrong with a key that has a NULL; NULL for a whole one."""
    return F.coalesce(*[F.when(F.col(k).isNull(), F.lit(f"NULL in key column {k}")) for k in keys])


def require_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The same rows; reading one with a NULL key fails the job.

    A filter: it costs no pass of its own, and stays whatever columns are read.
    """
    about = null_key_reason(keys)
    return rows.where(F.when(about.isNull(), True).otherwise(F.raise_error(about).cast("boolean")))
