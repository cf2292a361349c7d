"""The load run: listing, archives, records, typed rows, keyed tables."""

from __future__ import annotations

from concurrent.futures import Future, ThreadPoolExecutor
from functools import cache, reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tributary.operators.upsert import BATCH, ERROR, LAST, last_wins
from tributary.schemas import FULL, TABLES, TableSpec, registry
from tributary.session import working_session
from tributary.sources.archive import archive_paths, batch_records, evenly_split, inflated, read_blocks, records, unpack
from tributary.sources.extract import BAD, bad_records, keyed_rows, scan_records, split_rows
from tributary.sources.listing import pages_in_order, read_listing, read_pages, resolve_links, select_data_sets
from tributary.sources.tables import COPIES, SEQUENCE, KeyedTable, State, one_step
from tributary.storage import remove_folder

# Fixed value: the lines that the publisher's loader takes in one transaction.
BATCH_LINES = 10_000
# Tables whose archives hold up to so many bytes land at the same time.
TOGETHER_BYTES = 256 << 20

FAIL = "fail"
QUARANTINE = "quarantine"


def extract_records(blocks: DataFrame, on_duplicate: str, batch_lines: int = BATCH_LINES) -> DataFrame:
    """Records of unpacked extracts, with their batch where duplicates are judged by it."""
    return batch_records(blocks, batch_lines) if on_duplicate == BATCH else records(blocks)


def extract_rows(blocks: DataFrame, spec: TableSpec, on_duplicate: str = LAST) -> DataFrame:
    """Typed rows of unpacked extracts, one per key, with ``_seq`` and the number of its rows."""
    return unique_rows(keyed_rows(scan_records(extract_records(blocks, on_duplicate), spec.schema), spec), spec, on_duplicate)


def unique_rows(rows: DataFrame, spec: TableSpec, on_duplicate: str = LAST) -> DataFrame:
    """One of the typed rows per key, by their position.

    ``last``: the last one. ``error``: a key may occur once in an extract. ``batch``:
    once in each 10,000 physical lines of it, and the last batch wins.
    """
    rule, once_in = (ERROR, "batch") if on_duplicate == BATCH else (on_duplicate, "seq")
    unique = last_wins(rows, list(spec.keys), ["seq", "part", "row"], rule, once_in, COPIES)
    return unique.withColumnRenamed("seq", SEQUENCE).select(*spec.columns, SEQUENCE, COPIES)


def create_tables(spark: SparkSession, root: str) -> dict[str, KeyedTable]:
    """The five tables; those that exist keep their rows."""
    tables = {name: KeyedTable(spark, root, spec) for name, spec in TABLES.items()}
    for table in tables.values():
        table.create()
    return tables


def register_views(tables: dict[str, KeyedTable]) -> None:
    """Make the tables queryable by name with ``spark.sql``."""
    for name, table in tables.items():
        table.read().createOrReplaceTempView(name)


def chosen_archives(spark: SparkSession, chosen: list, seq: int) -> DataFrame:
    """Archives of the chosen data sets; a link is a zip file or a folder of them.

    The archives of a folder are parts of one extract, in name order.
    """
    parts = [
        archive_paths(spark, row["link"]).select(
            F.lit(row["table"]).alias("table"), F.lit(seq).cast("bigint").alias("seq"), "path", "length"
        )
        for row in chosen
    ]
    order = Window.partitionBy("table").orderBy("path")
    part = F.row_number().over(order).cast("bigint")
    return reduce(DataFrame.unionByName, parts).withColumn("part", part)


def turns(sizes: dict[str, int], together: int = TOGETHER_BYTES) -> list[list[str]]:
    """Names in turns: the largest first, then as many at a time as are no larger together.

    What tables hold on disk while they land is so bounded by what the largest does.
    Up to ``together`` bytes are one turn.
    """
    names = sorted(sizes, key=lambda name: (-sizes[name], name))
    found, room = [], 0
    for name in names:
        if not found or sizes[name] > room:
            found.append([])
            room = max(sizes[names[0]], together)
        found[-1].append(name)
        room -= sizes[name]
    return found


def quarantined(table: KeyedTable) -> DataFrame:
    """Bad records of all loads: ``seq, part, row, reason, record``."""
    return bad_records(table.spark, [f"{table.path}/{folder}" for folder in table.state().bad])


def load(
    spark: SparkSession,
    listing: str,
    items: str,
    root: str,
    mode: str = FULL,
    data_sets: DataFrame | None = None,
    on_duplicate: str = LAST,
    on_bad: str = FAIL,
) -> dict[str, State]:
    """Load the data sets of ``mode`` into the tables below ``root``.

    Nothing is loaded if a wanted data set has no link. All tables change in
    one step, after all rows were read, typed, checked and written; if one fails,
    none does. The states returned tell by ``counts`` what happened to the rows.

    A record that is short, has text that its type cannot hold, or a NULL key fails
    the load. With ``on_bad="quarantine"`` it is set aside instead, with its position
    and the reason, in the pass that types the others: ``quarantined`` reads them.
    """
    if on_bad not in (FAIL, QUARANTINE):
        raise ValueError(f"on_bad: {on_bad}")
    tables = create_tables(spark, root)
    links = resolve_links(read_listing(pages_in_order(read_pages(spark, listing, items))))
    # One row per data set of the registry.
    chosen = select_data_sets(registry(spark) if data_sets is None else data_sets, links, mode).collect()
    seq = 1 + max(table.state().last_seq for table in tables.values())

    found = chosen_archives(spark, chosen, seq).groupBy("table")
    found = found.agg(F.sum("length").alias("bytes"), F.count("path").alias("number"), F.max("length").alias("largest")).collect()
    sizes = {r["table"]: r for r in found}
    missing = [row["link"] for row in chosen if row["table"] not in sizes]
    if missing:
        raise FileNotFoundError(f"no archive at {', '.join(missing)}")

    @cache
    def session_of(partitions: int) -> SparkSession:
        return working_session(spark, spark__sql__shuffle__partitions=str(partitions))

    def own_table(name: str) -> KeyedTable:
        """The table in a session that dedupes rows in the partitions that they are written in."""
        return KeyedTable(session_of(tables[name].writers(sizes[name]["bytes"])), root, tables[name].spec)

    def archives(name: str) -> DataFrame:
        return chosen_archives(tables[name].spark, [row for row in chosen if row["table"] == name], seq)

    def stored_blocks(name: str) -> str | None:
        """The folder of the table's records; None if the task that inflates an archive may parse it as well."""
        size, number, largest = (sizes[name][c] for c in ("bytes", "number", "largest"))
        # Batches of lines are counted in a pass of its own.
        if on_duplicate != BATCH and evenly_split(size, largest, spark.sparkContext.defaultParallelism):
            return None
        return unpack(archives(name), number)

    def land(name: str, stored: Future) -> State:
        table, folder = tables[name], stored.result()
        blocks = read_blocks(table.spark, folder) if folder else inflated(archives(name), sizes[name]["number"])
        size = sizes[name]["bytes"]
        if on_bad == FAIL:
            state = table.land(extract_rows(blocks, table.spec, on_duplicate), seq, seq, size)
        else:
            state = land_sound(name, blocks, size)
        if folder:
            remove_folder(folder)
        return state

    def land_sound(name: str, blocks: DataFrame, size: int) -> State:
        """The sound rows landed, the bad records kept for as long as the table is."""
        table, spec = tables[name], tables[name].spec
        aside = table.new_bad_folder()
        path = f"{table.path}/{aside}"
        try:
            raw = scan_records(extract_records(blocks, on_duplicate), spec.schema)
            sound, _, number = split_rows(raw, spec, path)
            state = table.land(unique_rows(sound, spec, on_duplicate), seq, seq, size, bad=(aside, number))
        except BaseException:
            remove_folder(path)
            raise
        remove_folder(f"{path}/{BAD}=false")
        return state

    names = [row["table"] for row in chosen]
    tables = {name: own_table(name) for name in names}
    states = {}
    # The tables do not depend on each other: while a large archive is still
    # inflated in one task, the other tables use the rest of the cluster.
    with one_step(list(tables.values())), ThreadPoolExecutor(max_workers=len(names)) as pool:
        stored = {name: pool.submit(inheritable_thread_target(spark)(stored_blocks), name) for name in names}
        try:
            for turn in turns({name: sizes[name]["bytes"] for name in names}):
                states.update(zip(turn, pool.map(inheritable_thread_target(spark)(land), turn, [stored[name] for name in turn])))
        finally:
            for folder in (s.result() for s in stored.values() if not s.exception()):
                if folder:
                    remove_folder(folder)
    return {name: states[name] for name in names}
