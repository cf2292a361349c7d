"""CSV extracts: positional scan, field-count check, typed rows, CSV export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.functions.casts import cast_text, checked_text
from tributary.operators.keys import null_key_reason, require_keys
from tributary.schemas import TableSpec
from tributary.sources.archive import file_paths, read_blocks, records
from tributary.sources.ranges import SPLIT_BYTES, unpack_ranges

MALFORMED = "_malformed"
RECORD = "_record"
REASON = "_reason"
POSITION = ("seq", "part", "row", "batch")
BAD = "_bad"

# Comma, double quote doubled inside quotes, no escape character, newlines
# kept inside quotes, blanks kept.
DIALECT = {"sep": ",", "quote": '"', "escape": '"', "multiLine": "true"}
READ_OPTIONS = {
    **DIALECT,
    # An empty field is NULL for every type, quoted or not.
    "nullValue": "",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": MALFORMED,
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
WRITE_OPTIONS = {
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
ROWS_PER_FILE = 1_000_000
# Spark's CSV parser ends rows at its 20,480th column.
PARSER_COLUMNS = 20_000


def text_schema(schema: T.StructType) -> T.StructType:
    """The columns as text, and the raw text of rows of another length."""
    names = [*schema.fieldNames(), MALFORMED]
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def scan_csv(spark: SparkSession, path: str, schema: T.StructType, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Text columns of CSV files with a header line, bound by position.

    As strict as an archive's records, by the same way: a byte that is not UTF-8
    and a NUL are errors, a blank line is a record without fields. Rows longer
    than the schema are cut to it. A file is cut by ranges of ``split_bytes``, each
    by a task of its own, though newlines may lie inside quotes.
    """
    files = file_paths(spark, path).select(
        F.lit(0).cast("bigint").alias("seq"), F.lit(0).cast("bigint").alias("part"), "path", "length"
    )
    rows = scan_records(records(read_blocks(spark, unpack_ranges(files, split_bytes))), schema)
    return rows.drop("seq", "part", "row")


def within_width(record: Column, width: int) -> Column:
    """The record, cut to ``width`` fields if it has more than the parser takes."""
    field = r'(?:"[^"]*+"(?:"[^"]*+")*+|[^",]*+)'
    first = F.regexp_extract(record, f"^{field}(?:,{field}){{{width - 1}}}", 0)
    # A record has no more commas than bytes.
    return F.when((F.octet_length(record) >= PARSER_COLUMNS) & (commas(record) >= PARSER_COLUMNS), first).otherwise(record)


def scan_records(records: DataFrame, schema: T.StructType) -> DataFrame:
    """The same text columns from unpacked records, with position (and batch) and raw text."""
    kept = within_width(F.col("record"), len(schema.fields))
    fields = F.from_csv(kept, text_schema(schema).simpleString(), READ_OPTIONS)
    # An empty record has no fields; the parser gives no row for it.
    malformed = F.when(F.col("record") == "", F.col("record")).otherwise(F.col(f"fields.{MALFORMED}"))
    return records.withColumn("fields", fields).select(
        *[c for c in POSITION if c in records.columns],
        *[F.col("fields").getField(n).alias(n) for n in schema.fieldNames()],
        malformed.alias(MALFORMED),
        F.col("record").alias(RECORD),
    )


def field_count(record: Column) -> Column:
    """Fields of a record: the commas outside quotes, and one."""
    quoted = F.contains(record, F.lit('"'))
    return commas(F.when(quoted, F.regexp_replace(record, '"[^"]*+"', "")).otherwise(record)) + 1


def commas(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(","), F.lit("")))


def is_short(schema: T.StructType) -> Column:
    """True for rows of too few fields.

    Such a row is malformed and lacks its last field; only then are its fields
    counted, which tells it from a long row whose last kept field is empty.
    """
    last = schema.fieldNames()[-1]
    return (
        F.col(MALFORMED).isNotNull()
        & F.col(last).isNull()
        & (field_count(F.col(MALFORMED)) < len(schema.fields))
    )


def short_rows(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows that a load refuses because fields are missing."""
    return raw.where(is_short(schema))


def typed_rows(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Typed columns; a short row or a value of another type fails the job.

    The position is kept.
    """
    shown = F.col(RECORD if RECORD in raw.columns else MALFORMED)
    return cast_text(raw, schema, is_short(schema), short_reason(schema), shown).drop(MALFORMED, RECORD)


def short_reason(schema: T.StructType) -> str:
    return f"fewer than {len(schema.fields)} fields"


def keyed_rows(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """Typed rows of a table; a NULL in the key fails the job."""
    return require_keys(typed_rows(raw, spec.schema), list(spec.keys))


def judged_rows(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """Typed rows of a table, and why a row is bad: ``_bad``, ``_reason``, ``_record``.

    The reasons are those that would fail ``keyed_rows``; the typed columns of a bad
    row mean nothing. A sound row has no reason and no record. The position is kept.
    """
    checked, columns, reason = checked_text(raw, spec.schema, is_short(spec.schema), short_reason(spec.schema))
    position = [c for c in raw.columns if c not in (*spec.columns, MALFORMED, RECORD)]
    rows = checked.select(*position, *[columns[n].alias(n) for n in spec.columns], reason.alias(REASON), RECORD)
    rows = rows.withColumn(REASON, F.coalesce(REASON, null_key_reason(list(spec.keys))))
    bad = F.col(REASON).isNotNull()
    return rows.withColumns({BAD: bad, RECORD: F.when(bad, F.col(RECORD))})


def split_rows(raw: DataFrame, spec: TableSpec, path: str) -> tuple[DataFrame, DataFrame, int]:
    """Sound typed rows and bad records of one pass, and the number of bad ones.

    One job parses, types and writes both below ``path``, in a folder each; what is
    returned reads the folders. Bad records have ``seq, part, row, reason, record``.
    """
    judged = judged_rows(raw, spec)
    seen = Observation()
    judged.observe(seen, F.count_if(BAD).alias("bad")).write.partitionBy(BAD).parquet(path)
    number = seen.get["bad"]
    sound = raw.sparkSession.read.schema(judged.schema).parquet(path).where(~F.col(BAD)).drop(BAD, REASON, RECORD)
    return sound, bad_records(raw.sparkSession, [path] if number else []), number


BAD_SCHEMA = f"seq bigint, part bigint, row bigint, {REASON} string, {RECORD} string"


def bad_records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The bad records that ``split_rows`` left below the paths; none for no path."""
    folders = [f"{path}/{BAD}=true" for path in paths]
    rows = spark.read.schema(BAD_SCHEMA).parquet(*folders) if folders else spark.createDataFrame([], BAD_SCHEMA)
    return rows.select("seq", "part", "row", F.col(REASON).alias("reason"), F.col(RECORD).alias("record"))


def as_text(rows: DataFrame) -> DataFrame:
    """Every column as text that casts back to the same value."""
    return rows.select(*[F.col(c).cast("string").alias(c) for c in rows.columns])


def write_csv(rows: DataFrame, path: str) -> None:
    """CSV files with a header, fields quoted only where they must be."""
    writer = as_text(rows).write.options(**WRITE_OPTIONS).option("header", True)
    writer.option("maxRecordsPerFile", ROWS_PER_FILE).csv(path)
