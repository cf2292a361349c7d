"""Queries of the keyed tables: keys, upserts, incremental and load flows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.operators.keys import duplicate_keys, null_keys
from tributary.operators.upsert import last_wins
from tributary.plans.load import QUARANTINE, create_tables, load, quarantined
from tributary.schemas import DATA_SETS, DIFFERENTIAL, FULL, TABLES, TableSpec, registry
from tributary.session import working_session
from tributary.sources.export import csv_records, header_record, write_archives, write_listing
from tributary.sources.extract import WRITE_OPTIONS, as_text, field_count
from tributary.sources.tables import BUCKET_BYTES, COPIES, SEQUENCE, KeyedTable
from tributary.storage import remove_folder, work_folder
from tributary.streaming.incremental import follow
from tributary_queries import domain
from tributary_queries.domain import COLUMNS, DERIVED, DOMAIN, extract_schema, given, plain, stored
from tributary_queries.extracts import ITEMS, archive_number

# Which rows the table holds, which the extract holds, and what is new in them.
UPSERTS = {
    "org_units": ("code <> '9'", "code IN ('9', '11')", "name", "code"),
    "users": ("first_name <> 'MACHINERY'", "first_name IN ('MACHINERY', 'BUILDING')", "user_name", "org_defined_id"),
    "grade_objects": ("type_name <> 'PROMO'", "type_name IN ('PROMO', 'SMALL')", "name", "category_name"),
    "user_enrollments": ("role_name <> '1-URGENT'", "role_name IN ('1-URGENT', '2-HIGH')", None, "role_name"),
}
CHANGED = "changed "
COUNTED = ("read", "landed", "inserted", "replaced", "stale")


def landed(spark: SparkSession, spec: TableSpec, *extracts: tuple[int, DataFrame], **settings) -> KeyedTable:
    """A new table after its extracts, each with its number."""
    table = KeyedTable(spark, work_folder(spark, "tables"), spec, **settings)
    for number, rows in extracts:
        table.land(rows.withColumn(SEQUENCE, F.lit(number).cast("bigint")), number, number)
    return table


def _upsert(table: str):
    held, sent, renamed, emptied = UPSERTS[table]

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = DOMAIN[table](spark, sf_dir)
        if table in DERIVED:
            rows = stored(rows)
        extract = rows.where(sent).withColumn(emptied, F.lit(None).cast("string"))
        if renamed:
            extract = extract.withColumn(renamed, F.concat(F.lit(CHANGED), renamed))
        return plain(landed(spark, TABLES[table], (1, rows.where(held)), (2, extract)).read())

    return query


def _upsert_sql(table: str) -> str:
    held, sent, renamed, emptied = UPSERTS[table]
    changes = [f"CASE WHEN {sent} THEN NULL ELSE {emptied} END AS {emptied}"]
    if renamed:
        changes.append(f"CASE WHEN {sent} THEN '{CHANGED}' || {renamed} ELSE {renamed} END AS {renamed}")
    return f"SELECT * REPLACE ({', '.join(changes)}) FROM ({domain.SQL[table]}) fx"


def upsert_grade_results(spark, sf_dir):
    """Results without points come again with the numerator as denominator."""
    rows = stored(domain.grade_results(spark, sf_dir))
    held = rows.where("points_denominator <> points_numerator")
    sent = rows.where("points_denominator = 0 OR points_denominator = points_numerator")
    sent = sent.withColumns(
        {"points_denominator": F.col("points_numerator"), "points_numerator": F.col("points_denominator")}
    )
    return plain(landed(spark, TABLES["grade_results"], (1, held), (2, sent)).read())


def upsert_keeps_absent(spark, sf_dir):
    """A full extract without the inactive users: their rows stay."""
    rows = domain.users(spark, sf_dir)
    return landed(spark, TABLES["users"], (1, rows), (2, rows.where("is_active"))).read()


def upsert_into_empty(spark, sf_dir):
    orders = given(spark, sf_dir, "orders")
    return landed(spark, TableSpec("orders", ("o_orderkey",), orders.schema), (1, orders)).read()


def renamed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("user_name", F.concat(F.lit(CHANGED), "user_name"))


def users_with_pending(spark, sf_dir) -> KeyedTable:
    """Users, and two small extracts after them that are stored beside the base."""
    rows = domain.users(spark, sf_dir)
    second = renamed(rows.where("user_id % 25 = 0"))
    third = rows.where("user_id % 50 = 0").withColumn("last_name", F.lit(None).cast("string"))
    held = rows.where("user_id % 100 <> 0")
    # Whatever the files' overhead on small tables, nothing is merged yet.
    return landed(spark, TABLES["users"], (1, held), (2, second), (3, third), pending_share=100.0)


def upsert_pending(spark, sf_dir):
    """The table read while its deltas are pending."""
    return users_with_pending(spark, sf_dir).read()


def upsert_fold(spark, sf_dir):
    """The same after the deltas were merged into the base."""
    table = users_with_pending(spark, sf_dir)
    table.fold()
    return table.read()


def upsert_late_extract(spark, sf_dir):
    """An extract older than the base's adds users and replaces none."""
    rows = domain.users(spark, sf_dir)
    held = rows.where("first_name <> 'MACHINERY'")
    return landed(spark, TABLES["users"], (5, held), (3, renamed(rows)), pending_share=100.0).read()


def users_folded_in_part(spark, sf_dir) -> KeyedTable:
    """Users in 16 buckets, and an extract of one nation's users of three buckets, merged."""
    rows = domain.users(spark, sf_dir)
    table = KeyedTable(spark, work_folder(spark, "tables"), TABLES["users"], pending_share=100.0)
    table.land(rows.withColumn(SEQUENCE, F.lit(1).cast("bigint")), 1, 1, 16 * BUCKET_BYTES)
    some = renamed(rows.where("org_defined_id = '7' AND pmod(hash(user_id), 16) < 3"))
    table.land(some.withColumn(SEQUENCE, F.lit(2).cast("bigint")), 2, 2)
    table.fold()
    return table


def upsert_fold_touched(spark, sf_dir):
    """Users by nation after the merge; none is changed in a bucket that stayed in its folder."""
    table = users_folded_in_part(spark, sf_dir)
    state = table.state()
    written = F.col("_slot").isin(state.slots.get(state.base, []))
    return table._base(state).groupBy("org_defined_id").agg(
        F.count(F.lit(1)).alias("users"),
        F.count_if(F.startswith("user_name", F.lit(CHANGED)) & ~written).alias("changed_elsewhere"),
    )


def lookup_keys(spark, sf_dir):
    """Some users, one absent, looked up in a table with deltas pending."""
    table = users_with_pending(spark, sf_dir)
    keys = stored(given(spark, sf_dir, "customer").select((F.col("c_custkey") * 5).alias("user_id")).where("user_id % 35 = 0"))
    return table.rows_of(keys)


def load_counts(spark, sf_dir):
    """What a second load did, by its commit files: some users sent twice, some again, some new."""
    rows = domain.users(spark, sf_dir)
    table = KeyedTable(spark, work_folder(spark, "tables"), TABLES["users"])
    copies = F.when(F.col("user_id") % 10 == 0, 3).otherwise(1)

    def extract(where, number):
        sent = rows.where(where).withColumns({COPIES: copies, SEQUENCE: F.lit(number).cast("bigint")})
        return table.land(sent, number, number, 1 << 30).counts

    steps = [extract("user_id % 3 > 0", 5), extract("user_id % 4 > 0", 7), extract("is_active", 6)]
    return spark.createDataFrame([(n, *(c[k] for k in COUNTED)) for n, c in enumerate(steps, 1)], "step bigint, " + ", ".join(f"{k} bigint" for k in COUNTED))


def key_duplicates(spark, sf_dir):
    return duplicate_keys(given(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def key_nulls(spark, sf_dir):
    """Events keyed by user where the purchases have lost theirs."""
    user = F.when(F.col("event_type") != "purchase", F.col("user_id"))
    events = given(spark, sf_dir, "events").withColumn("user_id", user)
    return null_keys(events, ["event_id", "user_id"]).select("event_id")


def dedupe_last_wins(spark, sf_dir):
    events = given(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value")
    return last_wins(events, ["user_id", "event_type"], ["event_id"]).drop("event_id")


def incremental_upsert(spark, sf_dir):
    """Events in extracts by id, landed in any order, applied as a stream."""
    events = given(spark, sf_dir, "events").select("user_id", "event_type", "value", "event_id")
    number = archive_number(events)
    ordered = events.repartitionByRange(number, "event_id").sortWithinPartitions("event_id")
    state = events.drop("event_id")
    landing = work_folder(spark, "landing")
    write_archives(csv_records(ordered.drop("event_id")), landing, state.columns)

    spec = TableSpec("event_state", ("user_id", "event_type"), extract_schema(state))
    table = KeyedTable(spark, work_folder(spark, "tables"), spec)
    follow(table, landing, work_folder(spark, "stream"), archives_per_batch=number // 2).awaitTermination()
    return plain(table.read())


# --- load flows


def with_added_column(rows: DataFrame) -> DataFrame:
    """Newer publishers append columns; the loader cuts them off."""
    return rows.withColumn("added_later", F.lit('x, "y"'))


def publish(spark: SparkSession, extracts: dict[str, DataFrame], mode: str, landing: str | None = None) -> str:
    """Extracts as archives below ``landing``, and the listing that links to them."""
    landing, links = landing or work_folder(spark, "landing"), []
    for plugin, table, published in DATA_SETS:
        if published != mode:
            continue
        rows = with_added_column(extracts[table])
        folder = f"{landing}/{table}"
        write_archives(csv_records(rows), folder, rows.columns)
        links.append(("000000000001", plugin, folder))
    listing = f"{landing}/listing"
    write_listing(spark.createDataFrame(links, "page string, plugin string, link string"), listing, ITEMS)
    return listing


def load_published(spark: SparkSession, extracts: dict[str, DataFrame], root: str, mode: str) -> None:
    """Extracts published and loaded; their archives go when the tables hold them."""
    landing = work_folder(spark, "landing")
    load(spark, publish(spark, extracts, mode, landing), ITEMS, root, mode)
    remove_folder(landing)


def full_load(spark, sf_dir) -> tuple[str, dict[str, KeyedTable]]:
    """Root and tables after a full load of the domain tables."""
    own, root = working_session(spark), work_folder(spark, "tables")
    load_published(own, {name: rows(own, sf_dir) for name, rows in DOMAIN.items()}, root, FULL)
    return root, create_tables(spark, root)


def _flat_sql(table: str, source: str) -> str:
    """Every column of a table in one text, the first key apart; numbers as rounded doubles."""
    kinds = {f.name: f.dataType.simpleString() for f in TABLES[table].schema.fields}

    def text(name):
        kind = kinds[name]
        if kind.startswith("decimal"):
            return f"CAST(CAST(ROUND(CAST({name} AS DOUBLE) * 1000) AS BIGINT) AS STRING)"
        if kind.startswith("timestamp"):
            return f"left(CAST({name} AS STRING), 19)"
        return f"CAST({name} AS STRING)"

    joined = " || '|' || ".join(f"COALESCE({text(name)}, '-')" for name in COLUMNS[table])
    return f"SELECT '{table}' AS table_name, {TABLES[table].keys[0]} AS first_key, {joined} AS content FROM {source}"


def load_full_flow(spark, sf_dir):
    """Listing, archives, records, typed rows and upserts of all five tables."""
    _, tables = full_load(spark, sf_dir)
    shaped = []
    for name, table in tables.items():
        shaped.append(spark.sql(_flat_sql(name, "{rows}"), rows=table.read()))
    return reduce(DataFrame.unionByName, shaped)


def load_differential_flow(spark, sf_dir):
    """A full load, then a differential one with roles changed and users added."""
    own, root, path = working_session(spark), work_folder(spark, "tables"), work_folder(spark, "stored")
    enrollments = stored(domain.user_enrollments(own, sf_dir), path)
    rows = {name: table(own, sf_dir) for name, table in DOMAIN.items()}
    rows["user_enrollments"] = enrollments.where("role_name <> '1-URGENT'")
    load_published(own, rows, root, FULL)
    rows["user_enrollments"] = enrollments.where("role_name IN ('1-URGENT', '2-HIGH')").withColumn(
        "role_name", F.concat(F.lit(CHANGED), "role_name")
    )
    load_published(own, rows, root, DIFFERENTIAL)
    remove_folder(path)
    return create_tables(spark, root)["user_enrollments"].read()


def load_quarantine(spark, sf_dir):
    """A load of users with damaged records: all users, with the reason why some were set aside."""
    rows = domain.users(spark, sf_dir)
    damage = F.col("user_id") % 10
    text = as_text(rows).withColumns(
        {
            "is_active": F.when(damage == 5, "maybe").otherwise(F.col("is_active").cast("string")),
            "user_id": F.when(damage != 7, F.col("user_id").cast("string")),
        }
    )
    record = F.when(damage == 3, F.concat_ws(",", "user_id", "user_name", F.lit('"cut, short"')))
    whole = F.to_csv(F.struct(*[text[c] for c in text.columns]), WRITE_OPTIONS)
    landing, root = work_folder(spark, "users"), work_folder(spark, "tables")
    write_archives(text.select(F.coalesce(record, whole).alias("record")), landing, text.columns)
    data_sets = registry(spark).where(F.col("table") == "users")
    (plugin,) = (r["plugin"] for r in data_sets.where(F.col("mode") == FULL).collect())
    listing = work_folder(spark, "listing")
    write_listing(spark.createDataFrame([("1", plugin, landing)], "page string, plugin string, link string"), listing, ITEMS)
    load(spark, listing, ITEMS, root, FULL, data_sets, on_bad=QUARANTINE)
    users = create_tables(spark, root)["users"]
    bad = quarantined(users).select(F.split("record", ",")[1].alias("user_name"), "reason")
    return users.read("user_name").withColumn("reason", F.lit(None).cast("string")).unionByName(bad)


# --- catalog


def schema_catalog(spark, sf_dir):
    """All tables created, filled, and created again: name, key and rows of each."""
    root = work_folder(spark, "tables")
    for name, table in create_tables(spark, root).items():
        table.land(DOMAIN[name](spark, sf_dir).withColumn(SEQUENCE, F.lit(1).cast("bigint")), 1, 1)
    parts = [
        table.read().agg(
            F.lit(name).alias("table_name"),
            F.lit(",".join(table.keys)).alias("key_columns"),
            F.count(F.lit(1)).alias("row_count"),
        )
        for name, table in create_tables(spark, root).items()
    ]
    return reduce(DataFrame.unionByName, parts)


def schema_width(spark, sf_dir):
    """Fields of each table's published header, how many of them the table keeps, and its rows."""
    parts = []
    for name, shape in DOMAIN.items():
        rows = shape(spark, sf_dir)
        header = F.lit(header_record(with_added_column(rows).columns))
        parts.append(
            rows.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"),
                field_count(header).cast("bigint").alias("published"),
                F.lit(TABLES[name].width).cast("bigint").alias("kept"),
                "row_count",
            )
        )
    return reduce(DataFrame.unionByName, parts)


QUERIES = {
    "schema_catalog": schema_catalog,
    "schema_width": schema_width,
    "key_duplicates": key_duplicates,
    "key_nulls": key_nulls,
    **{f"upsert_{name}": _upsert(name) for name in UPSERTS},
    "upsert_grade_results": upsert_grade_results,
    "upsert_keeps_absent": upsert_keeps_absent,
    "upsert_into_empty": upsert_into_empty,
    "upsert_pending": upsert_pending,
    "upsert_fold": upsert_fold,
    "upsert_late_extract": upsert_late_extract,
    "upsert_fold_touched": upsert_fold_touched,
    "lookup_keys": lookup_keys,
    "load_counts": load_counts,
    "dedupe_last_wins": dedupe_last_wins,
    "incremental_upsert": incremental_upsert,
    "load_full_flow": load_full_flow,
    "load_differential_flow": load_differential_flow,
    "load_quarantine": load_quarantine,
}


def _counts_sql(values: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, {value}, COUNT(*) AS row_count FROM ({domain.SQL[name]}) t"
        for name, value in values.items()
    )


_PENDING = f"""
    SELECT * REPLACE (
        CASE WHEN user_id % 50 = 0 THEN NULL ELSE last_name END AS last_name,
        CASE WHEN user_id % 25 = 0 AND user_id % 50 <> 0 THEN '{CHANGED}' ELSE '' END || user_name AS user_name)
    FROM ({domain.SQL["users"]}) fx"""

_LAST_EVENT = """
    SELECT user_id, event_type, arg_max(value, event_id) AS value FROM events GROUP BY user_id, event_type"""

SQL = {
    "load_quarantine": """
        SELECT c_name AS user_name, CASE c_custkey % 10 WHEN 3 THEN 'fewer than 11 fields' WHEN 5 THEN 'column is_active: not a boolean'
                                         WHEN 7 THEN 'NULL in key column user_id' END AS reason
        FROM customer""",
    # The key columns and widths of the five tables.
    "schema_catalog": _counts_sql(
        {
            "org_units": "'org_unit_id' AS key_columns",
            "users": "'user_id' AS key_columns",
            "grade_objects": "'grade_object_id' AS key_columns",
            "grade_results": "'grade_object_id,org_unit_id,user_id' AS key_columns",
            "user_enrollments": "'org_unit_id,user_id' AS key_columns",
        },
    ),
    "schema_width": _counts_sql(
        {
            "org_units": "CAST(10 AS BIGINT) AS published, CAST(9 AS BIGINT) AS kept",
            "users": "CAST(12 AS BIGINT) AS published, CAST(11 AS BIGINT) AS kept",
            "grade_objects": "CAST(27 AS BIGINT) AS published, CAST(26 AS BIGINT) AS kept",
            "grade_results": "CAST(14 AS BIGINT) AS published, CAST(13 AS BIGINT) AS kept",
            "user_enrollments": "CAST(6 AS BIGINT) AS published, CAST(5 AS BIGINT) AS kept",
        },
    ),
    "key_duplicates": """
        SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""",
    "key_nulls": "SELECT event_id FROM events WHERE event_type = 'purchase'",
    **{f"upsert_{name}": _upsert_sql(name) for name in UPSERTS},
    "upsert_grade_results": f"""
        SELECT * REPLACE (
               CASE WHEN points_denominator = 0 OR points_denominator = points_numerator
                    THEN points_denominator ELSE points_numerator END AS points_numerator,
               CASE WHEN points_denominator = 0 OR points_denominator = points_numerator
                    THEN points_numerator ELSE points_denominator END AS points_denominator)
        FROM ({domain.SQL["grade_results"]}) fx""",
    "upsert_keeps_absent": domain.SQL["users"],
    "upsert_into_empty": "SELECT * FROM orders",
    "upsert_pending": _PENDING,
    "upsert_fold": _PENDING,
    "upsert_late_extract": f"""
        SELECT * REPLACE (CASE WHEN first_name = 'MACHINERY' THEN '{CHANGED}' ELSE '' END || user_name AS user_name)
        FROM ({domain.SQL["users"]}) fx""",
    "upsert_fold_touched": """
        SELECT CAST(c_nationkey AS VARCHAR) AS org_defined_id, COUNT(*) AS users, CAST(0 AS BIGINT) AS changed_elsewhere
        FROM customer GROUP BY c_nationkey""",
    "lookup_keys": f"SELECT * FROM ({_PENDING}) p WHERE user_id IN (SELECT c_custkey * 5 FROM customer) AND user_id % 35 = 0",
    "load_counts": """
        WITH u AS (SELECT c_custkey AS k, c_acctbal > 0 AS active, CASE WHEN c_custkey % 10 = 0 THEN 3 ELSE 1 END AS copies,
                          c_custkey % 3 > 0 AS one, c_custkey % 4 > 0 AS two FROM customer)
        SELECT CAST(1 AS BIGINT) AS step, CAST(SUM(copies) AS BIGINT) AS read, COUNT(*) AS landed, COUNT(*) AS inserted,
               CAST(0 AS BIGINT) AS replaced, CAST(0 AS BIGINT) AS stale FROM u WHERE one
        UNION ALL SELECT 2, CAST(SUM(copies) AS BIGINT), COUNT(*), COUNT(*) FILTER (WHERE NOT one), COUNT(*) FILTER (WHERE one), 0 FROM u WHERE two
        UNION ALL SELECT 3, CAST(SUM(copies) AS BIGINT), COUNT(*), COUNT(*) FILTER (WHERE NOT one AND NOT two),
                         COUNT(*) FILTER (WHERE one AND NOT two), COUNT(*) FILTER (WHERE two) FROM u WHERE active""",
    "dedupe_last_wins": _LAST_EVENT,
    "incremental_upsert": _LAST_EVENT,
    "load_full_flow": " UNION ALL ".join(
        _flat_sql(name, f"({domain.SQL[name]}) t") for name in COLUMNS
    ),
    "load_differential_flow": f"""
        SELECT org_unit_id, user_id,
               CASE WHEN role_name IN ('1-URGENT', '2-HIGH') THEN '{CHANGED}' ELSE '' END || role_name AS role_name,
               enrollment_date, enrollment_type
        FROM ({domain.SQL["user_enrollments"]}) fx""",
}
