"""Text to typed columns, failing on text the target type cannot hold.

Every cast reports bad text itself, so results do not depend on the
session's ``spark.sql.ansi.enabled``. The work is spread over several
projections with one check for all columns: a check per column makes the
generated code of a wide table too long for the JVM to compile.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Words for true and false; a leading part of a word counts
# as the word as long as it cannot mean the other value.
TRUE_WORDS = ["t", "tr", "tru", "true", "y", "ye", "yes", "on", "1"]
FALSE_WORDS = ["f", "fa", "fal", "fals", "false", "n", "no", "of", "off", "0"]

BOOLEANS = "map({})".format(
    ", ".join([f"'{w}', true" for w in TRUE_WORDS] + [f"'{w}', false" for w in FALSE_WORDS])
)
BLANKS = " \t\n\x0b\f\r"
# Begins with year, month and day.
DATED = r"^[\x00-\x20]*[+-]?[0-9]+-[0-9]+-[0-9]"
MICROSECOND = "INTERVAL '0.000001' SECOND"
FAULT = "_fault"


def parsed(text: Column, kind: T.DataType) -> Column:
    """The value of ``text``, NULL if it has none.

    A zone suffix of a timestamp is ignored, not applied. A year or a month
    alone is no timestamp, though the cast takes it for one.
    """
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, T.BooleanType):
        return F.try_element_at(F.expr(BOOLEANS), F.lower(F.trim(text, F.lit(BLANKS))))
    if isinstance(kind, T.TimestampNTZType):
        return F.when(text.rlike(DATED), text.try_cast(kind))
    return text.try_cast(kind)


def lost(text: Column, value: Column, kind: T.DataType) -> Column:
    """Whether the type does not hold the value of a text that is there.

    A decimal may have no more digits after the point than its scale, zeros at
    the end left out.
    """
    bad = text.isNotNull() & value.isNull()
    return bad | too_long(text, kind.scale) if isinstance(kind, T.DecimalType) else bad


def too_long(text: Column, scale: int) -> Column:
    """Whether a decimal has more digits after the point than ``scale``.

    They are the digits of its fraction less the exponent, less the zeros that
    end all its digits. Few texts have an exponent or so many digits; for these
    the count is a lambda, which adds nothing to the generated code.
    """

    def beyond(t: Column) -> Column:
        mantissa = F.regexp_extract(t, "[0-9.]+", 0)
        digits = F.replace(mantissa, F.lit("."), F.lit(""))
        kept = F.rtrim(digits, F.lit("0"))
        fraction = F.length(F.regexp_extract(mantissa, r"\.([0-9]*)", 1)).cast("bigint")
        exponent = F.coalesce(F.regexp_extract(t, "[eE]([+-]?[0-9]+)", 1).try_cast("bigint"), F.lit(0))
        return (kept != "") & (fraction - (F.length(digits) - F.length(kept)) - exponent > scale)

    point = F.instr(text, F.lit("."))
    rare = F.contains(text, F.lit("e")) | F.contains(text, F.lit("E")) | ((point > 0) & (F.octet_length(text) - point > scale))
    return rare & F.exists(F.array(text), beyond)


def rounded(text: Column, value: Column) -> Column:
    """A parsed timestamp to the nearest microsecond.

    The cast cuts a fraction of more than six digits.
    """
    fraction = F.regexp_extract(text, r"\.\d{7,}", 0)
    micros = F.rint(fraction.try_cast("double") * F.lit(1e6))
    up = micros > F.substring(fraction, 2, 6).try_cast("int")
    return F.when(F.contains(text, F.lit(".")) & up, value + F.expr(MICROSECOND)).otherwise(value)


def checked_text(
    rows: DataFrame, schema: T.StructType, fault: Column | None = None, about: str = ""
) -> tuple[DataFrame, dict[str, Column], Column]:
    """The rows with all casts made, the typed columns, and what is wrong with a row.

    The last is NULL for a sound row; else ``about`` where ``fault`` is true, or the
    first column whose text its type cannot hold.
    """
    casts = [f for f in schema.fields if not isinstance(f.dataType, T.StringType)]

    def text(name):
        return F.col(f"`{name}`")

    def value(name):
        return F.col(f"`_value_{name}`")

    values = rows.select("*", *[parsed(text(f.name), f.dataType).alias(f"_value_{f.name}") for f in casts])
    times = [f.name for f in casts if isinstance(f.dataType, T.TimestampNTZType)]
    values = values.withColumns({f"_value_{n}": rounded(text(n), value(n)) for n in times})

    # 1 for the row itself, then the number of the first column at fault.
    number = F.when(F.lit(False) if fault is None else fault, F.lit(1))
    for n, f in enumerate(casts, 2):
        number = number.when(lost(text(f.name), value(f.name), f.dataType), F.lit(n))
    # Adding 0 for the partition keeps the optimizer from moving the filter below
    # the casts, where it would repeat them all.
    checked = values.withColumn(FAULT, number + F.lit(0) * F.spark_partition_id())

    messages = [about, *[f"column {f.name}: not a {f.dataType.simpleString()}" for f in casts]]
    columns = {f.name: value(f.name).try_cast(f.dataType) if f in casts else text(f.name) for f in schema.fields}
    # Asked for place NULL, element_at() gives the last element.
    reason = F.element_at(F.array(*map(F.lit, messages)), F.col(FAULT))
    return checked, columns, F.when(F.col(FAULT).isNotNull(), reason)


def cast_text(
    rows: DataFrame,
    schema: T.StructType,
    fault: Column | None = None,
    about: str = "",
    shown: Column | None = None,
) -> DataFrame:
    """The text columns of ``schema`` typed; other columns are kept.

    Text that its type cannot hold fails the job, and so does a row where
    ``fault`` is true, with ``about`` as the message. ``shown`` is what a
    message quotes of the row.
    """
    names = schema.fieldNames()
    others = [c for c in rows.columns if c not in names]
    checked, columns, reason = checked_text(rows, schema, fault, about)
    quoted = F.lit("") if shown is None else F.coalesce(F.concat(F.lit(": "), F.left(shown, F.lit(200))), F.lit(""))
    failed = F.raise_error(F.concat(reason, quoted))
    # A filter, which no choice of columns removes.
    sound = checked.where(F.when(F.col(FAULT).isNull(), True).otherwise(failed.cast("boolean")))
    return sound.select(*[columns[n].alias(n) for n in names], *others)
