"""Last-wins dedupe and whole-row insert-or-replace by key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LAST = "last"
ERROR = "error"
BATCH = "batch"


def last_wins(
    rows: DataFrame,
    keys: list[str],
    position: list[str],
    on_duplicate: str = LAST,
    extract: str | None = None,
    copies: str | None = None,
) -> DataFrame:
    """One row per key: the one with the highest ``position``, NULLs included.

    An aggregate, not a window: it merges the copies of a key before the
    shuffle, so a key that holds a third of all rows costs one row per task.
    The position leads the compared struct; as it is unique, the other columns
    are carried along and never decide.

    With ``on_duplicate="error"`` a key may occur once only, or once per value
    of the column ``extract``. ``copies`` names a column for the number of rows
    that a row stands for.
    """
    if on_duplicate not in (LAST, ERROR):
        raise ValueError(f"on_duplicate: {on_duplicate}")
    rest = [c for c in rows.columns if c not in keys and c not in position and c != copies]
    row = F.max(F.struct(*position, *rest)).alias("_row")
    number = F.sum(copies) if copies in rows.columns else F.count(F.lit(1))
    if on_duplicate == LAST:
        counted = [number.alias(copies)] if copies else []
        return rows.groupBy(*keys).agg(row, *counted).select(*keys, "_row.*", *([copies] if copies else []))
    counted = rows.groupBy(*keys, *([F.col(extract).alias("_extract")] if extract else [])).agg(
        row, F.count(F.lit(1)).alias("_copies")
    )
    shown = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
    failed = F.raise_error(F.concat(F.lit("key occurs twice in an extract: "), shown)).cast("boolean")
    once = counted.where(F.when(F.col("_copies") == 1, True).otherwise(failed))
    single = once.select(*keys, "_row.*", *([F.lit(1).alias(copies)] if copies else []))
    return last_wins(single, keys, position, copies=copies) if extract else single


def without_keys(base: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``base`` whose key ``delta`` lacks.

    A ``delta`` whose keys are below the broadcast threshold leaves ``base``
    where it is; a larger one is joined on the key, which needs no shuffle of
    a base bucketed by it.
    """
    return base.join(delta.select(*keys), list(keys), "left_anti").select(*base.columns)


def same_key(left: str, right: str, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}") == F.col(f"{right}.{k}") for k in keys])


def matched(base: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    """All rows of both, joined by key: ``b`` of the base, ``d`` of a large ``delta``."""
    return base.alias("b").join(delta.alias("d"), same_key("b", "d", keys), "full_outer")


def newest(joined: DataFrame, columns: list[str], sequence: str) -> DataFrame:
    """Of ``matched`` rows that share a key the one with the higher ``sequence``, the delta's if they are equal."""
    old, new = F.col(f"b.{sequence}"), F.col(f"d.{sequence}")
    take_new = new.isNotNull() & (old.isNull() | (new >= old))
    return joined.select(*[F.when(take_new, F.col(f"d.{c}")).otherwise(F.col(f"b.{c}")).alias(c) for c in columns])


def merge(base: DataFrame, delta: DataFrame, keys: list[str], sequence: str) -> DataFrame:
    """The upsert in one pass over each side, for a large ``delta``."""
    return newest(matched(base, delta, keys), base.columns, sequence)


def drop_stale(base: DataFrame, delta: DataFrame, keys: list[str], sequence: str) -> DataFrame:
    """``delta`` without the rows for which ``base`` holds a later sequence.

    An outer join from ``delta``, so that it is never broadcast: nothing bounds
    the size of rows that are still to be parsed.
    """
    held = base.select(*keys, sequence).alias("b")
    joined = delta.alias("d").join(held, same_key("d", "b", keys), "left_outer")
    old, new = F.col(f"b.{sequence}"), F.col(f"d.{sequence}")
    return joined.where(old.isNull() | (new >= old)).select("d.*")
