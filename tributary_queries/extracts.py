"""Queries of the sources: listing, archives, CSV dialect and casts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.functions.casts import cast_text
from tributary.schemas import BOOL, DIFFERENTIAL, FULL, NUMBER, WHEN, TableSpec
from tributary.sources.archive import archive_paths, batch_records, read_blocks, records, unpack
from tributary.sources.export import csv_records, write_archives, write_listing
from tributary.sources.extract import scan_csv, scan_records, short_rows, typed_rows, write_csv
from tributary.sources.listing import pages_in_order, read_listing, read_pages, resolve_links, select_data_sets
from tributary.sources.tables import SEQUENCE, KeyedTable
from tributary.storage import folder_bytes, work_folder
from tributary_queries.domain import extract_schema, given, plain

ITEMS = "DataSets"
POSITION = ("seq", "part", "row")


def archive_number(rows: DataFrame) -> int:
    """Archives to write: one per input split, some even for small input."""
    return max(4, rows.rdd.getNumPartitions())


def through_archives(records_text: DataFrame, header: list[str]) -> DataFrame:
    """Records written to zip archives and unpacked again."""
    spark = records_text.sparkSession
    folder = work_folder(spark, "landing")
    write_archives(records_text.repartition(archive_number(records_text)), folder, header)
    archives = archive_paths(spark, folder).select(
        F.lit(1).cast("bigint").alias("seq"),
        F.lit(1).cast("bigint").alias("part"),
        "path",
        "length",
    )
    return records(read_blocks(spark, unpack(archives)))


def loaded(rows: DataFrame, records_text: DataFrame | None = None) -> DataFrame:
    """``rows`` after the way through archives, with the columns' own types."""
    schema = extract_schema(rows)
    text = csv_records(rows) if records_text is None else records_text
    raw = scan_records(through_archives(text, rows.columns), schema)
    return plain(typed_rows(raw, schema).drop(*POSITION))


# --- listing


def manifest_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as listing pages; those in debt are listed again, with a new link."""
    suppliers = given(spark, sf_dir, "supplier")
    number = F.lpad(F.floor(F.col("s_suppkey") / 50).cast("string"), 12, "0")

    def pages(rows, first, version):
        link = F.concat(F.lit(version), F.col("s_suppkey").cast("string"))
        return rows.select(
            F.concat(F.lit(first), number).alias("page"), F.col("s_name").alias("plugin"), link.alias("link")
        )

    again = pages(suppliers.where("s_acctbal < 0"), "1", "v2/")
    path = work_folder(spark, "listing")
    write_listing(pages(suppliers, "0", "v1/").unionByName(again), path, ITEMS)
    return resolve_links(read_listing(pages_in_order(read_pages(spark, path, ITEMS))))


def manifest_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of suppliers under names without order, numbered by their addresses."""
    suppliers = given(spark, sf_dir, "supplier").where("s_suppkey % 4 > 0")
    name = F.lpad((F.col("s_nationkey") * 100 + F.col("s_suppkey") % 7).cast("string"), 6, "0")
    path = work_folder(spark, "listing")
    write_listing(suppliers.select(name.alias("page"), F.col("s_name").alias("plugin"), F.lit("x").alias("link")), path, ITEMS)
    listed = read_listing(pages_in_order(read_pages(spark, path, ITEMS)))
    return listed.select("plugin", F.col("page").cast("bigint").alias("page"))


def _dataset_select(spark, sf_dir, mode):
    parts = given(spark, sf_dir, "part")
    plugin = F.col("p_partkey").cast("string").alias("plugin")
    registry = parts.select(
        plugin,
        F.col("p_name").alias("table"),
        F.when(F.col("p_type") == "PROMO", DIFFERENTIAL).otherwise(FULL).alias("mode"),
    )
    links = parts.select(plugin, F.concat_ws("/", "p_brand", "p_type").alias("link"))
    return select_data_sets(registry, links, mode)


def dataset_select_full(spark, sf_dir):
    return _dataset_select(spark, sf_dir, FULL)


def dataset_select_diff(spark, sf_dir):
    return _dataset_select(spark, sf_dir, DIFFERENTIAL)


# --- archives and CSV


def archive_extract(spark, sf_dir):
    """Customers, some with a stray quote in a field longer than Python's reader takes by itself."""
    customer = given(spark, sf_dir, "customer")
    long = F.concat(F.lit('5" '), F.repeat("c_mktsegment", F.lit(20_000)))
    segment = F.when(F.col("c_custkey") % 50 == 0, long).otherwise(F.col("c_mktsegment"))
    fields = [segment.alias(c) if c == "c_mktsegment" else F.col(c).cast("string") for c in customer.columns]
    found = loaded(customer, customer.select(F.concat_ws(",", *fields).alias("record")))
    return found.withColumn("c_mktsegment", F.sha2("c_mktsegment", 256))


def batch_numbers(spark, sf_dir):
    """Events in archives that are one extract, some with quoted newlines, numbered by batches of 700 lines."""
    events = given(spark, sf_dir, "events").select("event_id", "event_type")
    number = archive_number(events)
    lines = F.repeat(F.lit("and\n"), (F.col("event_id") % 3).cast("int"))
    rows = events.withColumn("event_type", F.concat("event_type", lines))
    landing = work_folder(spark, "landing")
    write_archives(csv_records(rows.repartitionByRange(number, "event_id").sortWithinPartitions("event_id")), landing, rows.columns)
    part = F.row_number().over(Window.orderBy("path")).cast("bigint")  # few archives
    archives = archive_paths(spark, landing).select(F.lit(1).cast("bigint").alias("seq"), part.alias("part"), "path", "length")
    records = batch_records(read_blocks(spark, unpack(archives)), 700)
    return records.select(F.split("record", ",")[0].cast("bigint").alias("event_id"), F.col("batch.number").alias("batch"))


def csv_scan_typed(spark, sf_dir):
    orders = given(spark, sf_dir, "orders")
    path, schema = work_folder(spark, "csv"), extract_schema(orders)
    write_csv(orders, path)
    return plain(typed_rows(scan_csv(spark, path, schema), schema))


def csv_multiline_quotes(spark, sf_dir):
    """Whole documents and pages: newlines, commas and quotes inside fields."""
    documents = given(spark, sf_dir, "documents").select(
        F.lit("document").alias("kind"), F.col("doc_id").alias("id"), "text"
    )
    pages = given(spark, sf_dir, "pages").select(
        F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.col("html").alias("text")
    )
    return loaded(documents.unionByName(pages))


def csv_scan_ranges(spark, sf_dir):
    """Whole documents in plain files, each cut by many tasks in the middle of quoted texts."""
    documents = given(spark, sf_dir, "documents")
    path = work_folder(spark, "csv")
    write_csv(documents, path)
    return typed_rows(scan_csv(spark, path, documents.schema, split_bytes=1 << 18), documents.schema)


def csv_write_roundtrip(spark, sf_dir):
    pages = given(spark, sf_dir, "pages")
    path = work_folder(spark, "csv")
    write_csv(pages, path)
    return typed_rows(scan_csv(spark, path, pages.schema), pages.schema)


def csv_additive_columns(spark, sf_dir):
    """Events published with two more columns than the table has."""
    events = given(spark, sf_dir, "events")
    wider = events.withColumns(
        {"note": F.concat(F.lit('said "'), "event_type", F.lit('", then left')), "props_again": F.col("props")}
    )
    return loaded(events, csv_records(wider))


def csv_short_rows(spark, sf_dir):
    """Orders where finished ones lack fields and pending ones have one more."""
    orders = given(spark, sf_dir, "orders")
    whole = [F.col(c).cast("string").alias(c) for c in orders.columns]
    record = (
        F.when(F.col("o_orderstatus") == "F", F.to_csv(F.struct(*whole[:3])))
        .when(F.col("o_orderstatus") == "P", F.to_csv(F.struct(*whole, F.lit("a,b").alias("more"))))
        .otherwise(F.to_csv(F.struct(*whole)))
    )
    schema = extract_schema(orders)
    raw = scan_records(through_archives(orders.select(record.alias("record")), orders.columns), schema)
    return short_rows(raw, schema).select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"))


def csv_empty_to_null(spark, sf_dir):
    """Empty fields, quoted and bare, next to filled ones."""
    customer = given(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    segment = (
        F.when(F.col("c_mktsegment") == "BUILDING", '""')
        .when(F.col("c_mktsegment") == "MACHINERY", "")
        .otherwise(F.col("c_mktsegment"))
    )
    return loaded(customer, customer.select(F.concat_ws(",", "c_custkey", segment).alias("record")))


# --- casts


def cast_boolean(spark, sf_dir):
    """One spelling per event type, true from a value of 50 on."""
    kind, high = F.col("event_type"), F.col("value") >= 50
    spelled = {
        "view": ("on", "off"),
        "click": ("T", "fal"),
        "signup": (" yes ", "N"),
        "purchase": ("1", "0"),
        "error": ("tru", "OF"),
    }
    word = F.coalesce(
        *[F.when(kind == k, F.when(high, yes).otherwise(no)) for k, (yes, no) in spelled.items()]
    )
    events = given(spark, sf_dir, "events").select("event_id", word.alias("flag"))
    return cast_text(events, T.StructType([T.StructField("flag", BOOL)]))


def cast_decimal(spark, sf_dir):
    """Prices as they are, and as text with twelve digits before the point, 18 after it, and exponents."""
    lines = given(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount"
    )
    found = loaded(lines)
    large = F.concat(F.lit("123456"), F.lpad(F.col("l_orderkey").cast("string"), 12, "0"), F.lit("."), F.lpad(F.col("l_partkey").cast("string"), 18, "0"))
    texts = {
        "large": large,
        "small": F.concat(F.col("l_suppkey").cast("string"), F.lit("e-18")),
        "tiny": F.concat(F.col("l_suppkey").cast("string"), F.lit(".5e-10")),
        "thousandths": F.concat(F.col("l_partkey").cast("string"), F.lit(".1234567891E-3")),
    }
    wide = T.StructType([T.StructField(name, NUMBER) for name in texts])
    typed = cast_text(found.withColumns(texts), wide)
    return typed.withColumns({c: F.col(c).cast("string") for c in texts})


def cast_timestamp(spark, sf_dir):
    """Times as text with a ``T`` and a zone that does not shift them.

    ``short`` has no leading zeros and seven digits of a second, to be rounded.
    """
    text = F.regexp_replace(F.col("ts").cast("string"), " ", "T")
    zoned = F.concat(text, F.when(F.col("event_type") == "view", "+05:00").otherwise("Z"))
    short = F.concat(F.date_format("ts", "yyyy-M-d HH:mm:ss"), F.lit(".1234567 "))
    events = given(spark, sf_dir, "events").select("event_id", zoned.alias("ts"), short.alias("short"))
    return cast_text(events, T.StructType([T.StructField("ts", WHEN), T.StructField("short", WHEN)]))


# --- tables


def snapshot_publish(spark, sf_dir):
    """Orders landed, then landed again where pending, read as the table is now."""
    orders = given(spark, sf_dir, "orders")
    table = KeyedTable(spark, work_folder(spark, "tables"), TableSpec("orders", ("o_orderkey",), orders.schema))
    size = folder_bytes(sf_dir)
    table.land(orders.withColumn(SEQUENCE, F.lit(1).cast("bigint")), 1, 1, size)
    edited = orders.where("o_orderstatus = 'P'").withColumns(
        {"o_orderpriority": F.lit("0-EDITED"), SEQUENCE: F.lit(2).cast("bigint")}
    )
    table.land(edited, 2, 2, size)
    return table.read()


QUERIES = {
    "manifest_resolve": manifest_resolve,
    "manifest_chain": manifest_chain,
    "dataset_select_full": dataset_select_full,
    "dataset_select_diff": dataset_select_diff,
    "archive_extract": archive_extract,
    "batch_numbers": batch_numbers,
    "csv_scan_typed": csv_scan_typed,
    "csv_multiline_quotes": csv_multiline_quotes,
    "csv_scan_ranges": csv_scan_ranges,
    "csv_write_roundtrip": csv_write_roundtrip,
    "csv_additive_columns": csv_additive_columns,
    "csv_short_rows": csv_short_rows,
    "csv_empty_to_null": csv_empty_to_null,
    "cast_boolean": cast_boolean,
    "cast_decimal": cast_decimal,
    "cast_timestamp": cast_timestamp,
    "snapshot_publish": snapshot_publish,
}

_SELECT = """
    SELECT CAST(p_partkey AS VARCHAR) AS plugin, p_name AS "table", p_brand || '/' || p_type AS link
    FROM part WHERE p_type {} 'PROMO'"""

SQL = {
    "manifest_resolve": """
        SELECT s_name AS plugin, CASE WHEN s_acctbal < 0 THEN 'v2/' ELSE 'v1/' END || s_suppkey AS link
        FROM supplier""",
    # The chain followed page by page.
    "manifest_chain": """
        WITH RECURSIVE named AS (
            SELECT s_name, lpad(CAST(s_nationkey * 100 + s_suppkey % 7 AS VARCHAR), 6, '0') AS url FROM supplier WHERE s_suppkey % 4 > 0
        ), pages AS (SELECT url, lead(url) OVER (ORDER BY url) AS next FROM (SELECT DISTINCT url FROM named) u
        ), chain AS (
            SELECT url, next, CAST(1 AS BIGINT) AS page FROM pages WHERE url NOT IN (SELECT next FROM pages WHERE next IS NOT NULL)
            UNION ALL SELECT p.url, p.next, c.page + 1 FROM chain c JOIN pages p ON p.url = c.next
        )
        SELECT s_name AS plugin, page FROM named JOIN chain USING (url)""",
    "dataset_select_full": _SELECT.format("<>"),
    "dataset_select_diff": _SELECT.format("="),
    "archive_extract": """
        SELECT * REPLACE (sha256(CASE WHEN c_custkey % 50 = 0 THEN '5" ' || repeat(c_mktsegment, 20000)
                                      ELSE c_mktsegment END) AS c_mktsegment)
        FROM customer""",
    "batch_numbers": """
        SELECT event_id, CAST((SUM(1 + event_id % 3) OVER (ORDER BY event_id) - 1 - event_id % 3) // 700 AS BIGINT) AS batch FROM events""",
    "csv_scan_typed": "SELECT * FROM orders",
    "csv_multiline_quotes": """
        SELECT 'document' AS kind, doc_id AS id, text FROM documents
        UNION ALL SELECT 'page' AS kind, page_id AS id, html AS text FROM pages""",
    "csv_scan_ranges": "SELECT * FROM documents",
    "csv_write_roundtrip": "SELECT * FROM pages",
    "csv_additive_columns": "SELECT * FROM events",
    "csv_short_rows": "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'",
    "csv_empty_to_null": """
        SELECT c_custkey,
               CASE WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY') THEN c_mktsegment END AS c_mktsegment
        FROM customer""",
    "cast_boolean": "SELECT event_id, value >= 50 AS flag FROM events",
    "cast_decimal": """
        SELECT l_orderkey, l_partkey, l_suppkey, l_extendedprice, l_discount,
               '123456' || lpad(CAST(l_orderkey AS VARCHAR), 12, '0') || '.' || lpad(CAST(l_partkey AS VARCHAR), 18, '0') AS large,
               '0.' || lpad(CAST(l_suppkey AS VARCHAR), 18, '0') AS small,
               '0.' || lpad(CAST(l_suppkey * 10 + 5 AS VARCHAR), 11, '0') || '0000000' AS tiny,
               CAST(l_partkey // 1000 AS VARCHAR) || '.' || lpad(CAST(l_partkey % 1000 AS VARCHAR), 3, '0') || '123456789100000' AS thousandths
        FROM lineitem""",
    "cast_timestamp": """
        SELECT event_id, ts, date_trunc('second', ts) + INTERVAL '123457 microseconds' AS short FROM events""",
    "snapshot_publish": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
               CASE WHEN o_orderstatus = 'P' THEN '0-EDITED' ELSE o_orderpriority END AS o_orderpriority
        FROM orders""",
}
