"""Keyed tables: a base in buckets, pending deltas and a commit file per change.

``<root>/<table>/_commits/<version>.json`` names the folders that make up a
version of the table, and ``<root>/_runs/<number>.json`` the version of every
table. Data always goes to a new folder and counts from the moment a run file
names its version, so a failed load leaves the tables as they were, several
tables change in one step, and readers of an older version keep their files.

A delta that is small beside the base is stored as it is and joined in when
the table is read: a differential load then costs what the delta costs. A
large one is merged with the base into a new base at once, and so are the
pending deltas when they have grown. Only the buckets that hold one of their
keys are written again; the others stay in the folders that they are in.
"""

from __future__ import annotations

import math
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.operators.upsert import drop_stale, last_wins, matched, newest, without_keys
from tributary.schemas import LONG, TableSpec
from tributary.storage import create_json, file_names, folder_bytes, folder_names, read_json, remove_file, remove_folder

# Stored with each row: the number of its extract and, in deltas, the version
# that landed it, which decides between copies of one extract.
SEQUENCE = "_seq"
TURN = "_turn"
# May come with each row: the number of extract rows that it stands for.
COPIES = "_copies"
# The bucket of a row, a folder of its own in each base.
SLOT = "_slot"

BUCKET_BYTES = 32 << 20
# Pending deltas may reach this share of the base before they are merged.
PENDING_SHARE = 0.1
# So many pending deltas are made one.
PENDING_DELTAS = 16
# Sorted rows in row groups and pages of few keys, so that a lookup reads few of them.
BASE_FILES = {
    "compression": "zstd",
    "parquet.block.size": str(8 << 20),
    "parquet.bloom.filter.enabled#{key}": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",
}
# Up to so many keys are looked up in the base one by one; of more, their range.
FEW_KEYS = 1000

_defining = threading.Lock()


@dataclass(frozen=True)
class State:
    """One version of a table."""

    version: int = 0
    base: str | None = None
    base_bytes: int = 0
    base_last_seq: int = -1
    buckets: int = 1
    # The folders of the base, each with the buckets that are read from it.
    slots: dict[str, list[int]] = field(default_factory=dict)
    deltas: tuple[str, ...] = ()
    delta_bytes: int = 0
    last_seq: int = -1
    # Last micro-batch applied per stream, so that a repeated one is skipped.
    applied: dict[str, int] = field(default_factory=dict)
    # What the step that made this version did, in rows: "read" from extracts and
    # "landed" of them; of those merged with the base "inserted", "replaced", "stale".
    counts: dict[str, int] = field(default_factory=dict)
    # Folders of the records that loads have set aside.
    bad: tuple[str, ...] = ()

    @property
    def folders(self) -> set[str]:
        """All folders that this version reads."""
        return {f"{folder}/{SLOT}={slot}" for folder, slots in self.slots.items() for slot in slots} | set(self.deltas)


class Runs:
    """The version of every table below a root, changed in single steps."""

    def __init__(self, root: str):
        self.path = f"{root.rstrip('/')}/_runs"

    def _names(self) -> list[str]:
        return [n for n in file_names(self.path) if n.endswith(".json")]

    def newest(self) -> tuple[int, dict[str, int]]:
        """Number of the last run and the versions it left."""
        names = self._names()
        return (int(names[-1].split(".")[0]), read_json(f"{self.path}/{names[-1]}")) if names else (0, {})

    def publish(self, changed: dict[str, tuple[int | None, int]]) -> None:
        """Make new versions visible, all at once: ``{table: (version before, version)}``.

        A table that another run has changed meanwhile is an error; other tables
        may have been.
        """
        while True:
            number, versions = self.newest()
            for name, (before, _) in changed.items():
                if versions.get(name) != before:
                    raise FileExistsError(f"table {name} was changed by another run")
            after = {name: version for name, (_, version) in changed.items()}
            try:
                return create_json(self.path, f"{number + 1:012d}.json", {**versions, **after})
            except FileExistsError:
                continue  # another table's run took the number

    def remove_older(self) -> None:
        for name in self._names()[:-1]:
            remove_file(f"{self.path}/{name}")


@contextmanager
def one_step(tables: list[KeyedTable]) -> Iterator[None]:
    """What the tables take in the block becomes visible together at its end.

    If the block fails nothing does, whatever some of the tables have written.
    The tables must exist and lie below one root.
    """
    begun = {table.spec.name: table.state().version for table in tables}
    for table in tables:
        table.held = table.state()
    try:
        yield
        changed = {t.spec.name: (begun[t.spec.name], t.held.version) for t in tables if t.held.version != begun[t.spec.name]}
        if changed:
            tables[0].runs.publish(changed)
    finally:
        for table in tables:
            table.held = None


class KeyedTable:
    """A table that holds one row per key."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        spec: TableSpec,
        pending_share: float = PENDING_SHARE,
        bucket_bytes: int = BUCKET_BYTES,
    ):
        self.spark = spark
        self.spec = spec
        self.keys = list(spec.keys)
        self.path = f"{root.rstrip('/')}/{spec.name}"
        self.runs = Runs(root)
        # Within ``one_step`` the version that only this object sees.
        self.held: State | None = None
        self.pending_share = pending_share
        self.bucket_bytes = bucket_bytes
        fields = [T.StructField(f.name, f.dataType) for f in spec.schema.fields]
        self.stored = T.StructType([*fields, T.StructField(SEQUENCE, LONG)])

    # --- versions

    def state(self) -> State | None:
        """The newest visible version, or None if the table was never created."""
        if self.held:
            return self.held
        version = self.runs.newest()[1].get(self.spec.name)
        return None if version is None else self._read_commit(f"{version:012d}.json")

    def _commits(self) -> list[str]:
        return [n for n in file_names(f"{self.path}/_commits") if n.endswith(".json")]

    def _read_commit(self, name: str) -> State:
        found = read_json(f"{self.path}/_commits/{name}")
        return State(**{**found, "deltas": tuple(found["deltas"]), "bad": tuple(found["bad"])})

    def create(self) -> State:
        """Create the table if absent; one that exists is left as it is."""
        state = self.state()
        if state is None:
            state = self._commit(State(version=self._next(State())), None)
        return state

    def _next(self, state: State) -> int:
        """The next free version: a run that failed may have left some."""
        commits = self._commits()
        return 1 + max(state.version, int(commits[-1].split(".")[0]) if commits else 0)

    def _commit(self, state: State, before: State | None) -> State:
        create_json(f"{self.path}/_commits", f"{state.version:012d}.json", asdict(state))
        if self.held:
            self.held = state
        else:
            self.runs.publish({self.spec.name: (before and before.version, state.version)})
        return state

    def remove_older(self, keep: int = 1) -> list[str]:
        """Remove the folders that only versions before the newest ``keep`` use.

        For when nobody reads those versions any more. Folders that no commit
        names, such as those of a load under way, are left alone, and so is
        what commits after the visible version name.
        """
        newest = f"{self.state().version:012d}.json"
        commits = [n for n in self._commits() if n <= newest]
        older, kept = commits[: -max(1, keep)], commits[-max(1, keep) :]
        used = set().union(*(self._read_commit(c).folders for c in kept))
        unused = {folder for c in older for folder in self._read_commit(c).folders} - used
        for commit in older:
            state = self._read_commit(commit)
            if state.base and all(self._read_commit(c).base != state.base for c in kept):
                self.spark.sql(f"DROP TABLE IF EXISTS `{state.base}`")
            remove_file(f"{self.path}/_commits/{commit}")
        # A folder of which no bucket is read any more goes as a whole.
        still = {folder.split("/")[0] for folder in used}
        gone = {folder if folder.split("/")[0] in still else folder.split("/")[0] for folder in unused}
        for folder in gone:
            remove_folder(f"{self.path}/{folder}")
        self.runs.remove_older()
        return sorted(gone)

    # --- reading

    def read(self, *columns: str) -> DataFrame:
        """The rows of the newest version, all columns or the given ones.

        Spark cannot leave columns out of deltas that it has to dedupe; naming
        them here does.
        """
        state = self.state()
        if state is None:
            raise LookupError(f"table {self.spec.name} does not exist in {self.path}")
        wanted = list(columns or self.spec.columns)
        return self._rows(state, list(dict.fromkeys([*self.keys, *wanted]))).select(*wanted)

    def _rows(self, state: State, columns: list[str]) -> DataFrame:
        base = self._base(state).select(*columns)
        if not state.deltas:
            return base
        # Copies of a key do no harm in the anti join. Deduped deltas would: Spark
        # keeps their partitions and moves the base if it has fewer buckets.
        kept = without_keys(base, self._delta_rows(state), self.keys)
        return kept.unionByName(self._pending(state, columns))

    def _base(self, state: State) -> DataFrame:
        """The rows of the base, each with its bucket."""
        if state.base is None:
            return self.spark.createDataFrame([], self.stored).withColumn(SLOT, self._slot(1))
        with _defining:
            if not self.spark.catalog.tableExists(state.base):
                self._define(state)
        return self.spark.table(state.base)

    def _define(self, state: State) -> None:
        """Declare the base to the session: one table over buckets in several folders."""

        def located(folder: str) -> str:
            escaped = f"{self.path}/{folder}".replace("\\", "\\\\").replace("'", "\\'")
            return f"LOCATION '{escaped}'"

        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*self.stored, T.StructField(SLOT, T.IntegerType())])
        keys = ", ".join(f"`{k}`" for k in self.keys)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS `{state.base}` ({columns}) USING parquet PARTITIONED BY (`{SLOT}`)"
            f" CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {state.buckets} BUCKETS {located(state.base)}"
        )
        parts = [f"PARTITION (`{SLOT}`={n}) {located(f'{folder}/{SLOT}={n}')}" for folder, slots in state.slots.items() for n in slots]
        for some in range(0, len(parts), 1000):
            self.spark.sql(f"ALTER TABLE `{state.base}` ADD IF NOT EXISTS {' '.join(parts[some : some + 1000])}")

    def _slot(self, buckets: int) -> Column:
        """The bucket that Spark deals a row to."""
        return F.pmod(F.hash(*self.keys), F.lit(buckets)).cast("int")

    def _near(self, state: State, delta: DataFrame) -> DataFrame:
        """The rows of the base that may share a key with ``delta``, which is stored and small.

        Its buckets pick folders. The range of its first key, or the keys themselves
        if they are few, go down to the files: rows are sorted by key, so pages and
        row groups without them are not read.
        """
        first = F.col(self.keys[0])
        found = delta.agg(F.min(first).alias("low"), F.max(first).alias("high"), F.sort_array(F.collect_set(self._slot(state.buckets))).alias("slots")).first()
        few = [r[0] for r in delta.select(first).distinct().limit(FEW_KEYS + 1).collect()]
        base = self._base(state).where(F.col(SLOT).isin(found["slots"]))
        return base.where(first.isin(few) if len(few) <= FEW_KEYS else first.between(found["low"], found["high"]))

    def rows_of(self, keys: DataFrame) -> DataFrame:
        """The rows of the keys in ``keys``, a stored and small frame with the key columns.

        Only what may hold them is read of the base.
        """
        state = self.state()
        wanted = keys.select(*self.keys).distinct()
        base = self._near(state, keys).select(*self.stored.fieldNames()).join(wanted, self.keys, "left_semi")
        if state.deltas:
            deltas = self._delta_rows(state).join(wanted, self.keys, "left_semi")
            pending = last_wins(deltas, self.keys, [SEQUENCE, TURN]).drop(TURN)
            base = without_keys(base, pending, self.keys).unionByName(pending)
        return base.select(*self.spec.columns)

    def _delta_rows(self, state: State, *names: str) -> DataFrame:
        """Rows of the pending deltas, or of the named ones, each with the version that landed it."""
        schema = T.StructType([*self.stored.fields, T.StructField(TURN, LONG)])
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{name}" for name in names or state.deltas])

    def _pending(self, state: State, columns: list[str]) -> DataFrame:
        """One row per key from the pending deltas."""
        rows = self._delta_rows(state)
        if len(state.deltas) > 1:
            needed = dict.fromkeys([*columns, SEQUENCE, TURN])
            rows = last_wins(rows.select(*needed), self.keys, [SEQUENCE, TURN])
        return rows.select(*columns)

    # --- writing

    def land(
        self,
        rows: DataFrame,
        first_seq: int,
        last_seq: int,
        input_bytes: int | None = None,
        source: str | None = None,
        batch: int = -1,
        bad: tuple[str, int] | None = None,
    ) -> State:
        """Upsert ``rows``: the columns of the table and ``_seq``, one row per key.

        ``first_seq`` and ``last_seq`` bound the extracts in ``rows``. A row
        older than the one the table holds for its key is dropped.
        ``input_bytes``, the size of what ``rows`` are read from, decides
        between storing a delta and merging at once. With a column ``_copies`` the
        counts of the state tell how many extract rows there were. ``bad`` names the
        folder of records set aside by the same load, and their number.
        """
        state = self.create()
        if source is not None and batch <= state.applied.get(source, -1):
            return state
        copies = F.col(COPIES) if COPIES in rows.columns else F.lit(1)
        rows = rows.select(*self.stored.fieldNames(), copies.cast("bigint").alias(COPIES))
        applied = state.applied if source is None else {**state.applied, source: batch}
        landed = replace(state, last_seq=max(state.last_seq, last_seq), applied=applied, counts={})
        if bad is not None:
            landed = replace(landed, counts={"bad": bad[1]}, bad=(*state.bad, bad[0]) if bad[1] else state.bad)
        if state.base is None:
            return self._first_base(landed, rows, input_bytes)
        if input_bytes is not None and self._is_large(landed, input_bytes):
            return self._merge(landed, rows, input_bytes)
        return self._append(landed, rows, first_seq)

    def _is_large(self, state: State, more_bytes: int) -> bool:
        return state.delta_bytes + more_bytes > self.pending_share * state.base_bytes

    def _append(self, state: State, rows: DataFrame, first_seq: int) -> State:
        version = self._next(state)
        name = self._new_name(version, "delta")
        path = f"{self.path}/{name}"
        seen = Observation()
        counted = rows.observe(seen, *_read_counts())
        counted.drop(COPIES).withColumn(TURN, F.lit(version).cast("bigint")).write.parquet(path)
        counts = _filled(seen)
        if first_seq <= state.base_last_seq and counts["landed"]:
            # Keys are at hand only now that the rows are parsed.
            delta = self._delta_rows(state, name)
            kept, late = Observation(), self._new_name(version, "delta")
            fresh = drop_stale(self._near(state, delta), delta, self.keys, SEQUENCE)
            fresh.observe(kept, F.count(F.lit(1)).alias("kept")).write.parquet(f"{self.path}/{late}")
            remove_folder(path)
            name, path = late, f"{self.path}/{late}"
            counts["stale"] = counts["landed"] - _filled(kept)["kept"]
        state = self._commit(
            replace(
                state,
                version=version,
                deltas=(*state.deltas, name),
                delta_bytes=state.delta_bytes + folder_bytes(path),
                counts={**state.counts, **counts},
            ),
            state,
        )
        if self._is_large(state, 0):
            return self.fold()
        return self._gather(state) if len(state.deltas) >= PENDING_DELTAS else state

    def _gather(self, state: State) -> State:
        """Make the pending deltas one, so that many small ones stay cheap to read."""
        version = self._next(state)
        name = self._new_name(version, "delta")
        rows = last_wins(self._delta_rows(state), self.keys, [SEQUENCE, TURN])
        rows.select(*self.stored.fieldNames(), TURN).write.parquet(f"{self.path}/{name}")
        size = folder_bytes(f"{self.path}/{name}")
        return self._commit(replace(state, version=version, deltas=(name,), delta_bytes=size), state)

    def fold(self) -> State:
        """Merge the pending deltas into a new base."""
        state = self.create()
        if not state.deltas:
            return state
        return self._merge(state, None, 0)

    def _merge(self, state: State, rows: DataFrame | None, input_bytes: int) -> State:
        buckets = self._buckets(state, state.base_bytes + state.delta_bytes + input_bytes)
        if rows is None:
            touched = self._touched(state) if buckets == state.buckets else None
            return self._write_merged(state, self._pending(state, self.stored.fieldNames()).withColumn(COPIES, F.lit(0)), buckets, touched)
        if state.deltas:
            turned = rows.withColumn(TURN, F.lit(self._next(state)).cast("bigint"))
            both = self._delta_rows(state).withColumn(COPIES, F.lit(0).cast("bigint")).unionByName(turned)
            rows = last_wins(both, self.keys, [SEQUENCE, TURN], copies=COPIES).drop(TURN)
        return self._write_merged(state, rows, buckets)

    def _touched(self, state: State) -> list[int] | None:
        """The buckets that the pending deltas have keys of; None if these are all."""
        slots = [r[0] for r in self._delta_rows(state).select(self._slot(state.buckets)).distinct().collect()]
        return sorted(slots) if len(slots) < state.buckets else None

    def _merged(self, state: State, rows: DataFrame, buckets: int, touched: list[int] | None = None) -> DataFrame:
        """Base and rows, joined in the buckets of the base to come."""
        base = self._base(state)
        if touched is not None:
            base = base.where(F.col(SLOT).isin(touched))
        if buckets != state.buckets:
            base = base.repartition(buckets, *self.keys)
        base = base.select(*self.stored.fieldNames())
        # Spark would rather move the base than rows that are already hashed into
        # more partitions than the base has buckets.
        return matched(base, rows.repartition(buckets, *self.keys), self.keys)

    def _write_merged(self, state: State, rows: DataFrame, buckets: int, touched: list[int] | None = None) -> State:
        joined = self._merged(state, rows, buckets, touched)
        seen = Observation()
        new, old = F.col(f"d.{SEQUENCE}"), F.col(f"b.{SEQUENCE}")
        joined = joined.observe(
            seen,
            F.coalesce(F.sum(f"d.{COPIES}"), F.lit(0)).alias("read"),
            F.count(F.when(F.col(f"d.{COPIES}") > 0, 1)).alias("landed"),
            F.count_if(new.isNotNull() & old.isNull()).alias("inserted"),
            F.count_if(new >= old).alias("replaced"),
            F.count_if(new < old).alias("stale"),
        )
        chosen = newest(joined, self.stored.fieldNames(), SEQUENCE)
        return self._write_base(state, chosen, buckets, seen, touched)

    def _tasks(self) -> int:
        return int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    def _buckets(self, state: State, size: int | None) -> int:
        """Buckets of the next base: they follow the table's size, not the session."""
        most = int(self.spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
        wanted = self._tasks() if size is None else max(1, math.ceil(size / self.bucket_bytes))
        # A growing table gets more buckets rarely, a shrinking load no fewer.
        return state.buckets if state.base is not None and wanted < 4 * state.buckets else min(most, wanted)

    def writers(self, size: int) -> int:
        """Partitions in which the rows of a first base need not move again to be written, else the session's."""
        state, tasks = self.create(), self._tasks()
        buckets = self._buckets(state, size)
        return tasks if state.base else buckets * math.ceil(tasks / buckets)

    def _first_base(self, state: State, rows: DataFrame, size: int | None) -> State:
        """Rows come deduped in the session's number of partitions.

        With a multiple of the buckets each task writes to one of them, and few
        buckets are still written by many tasks.
        """
        tasks, buckets = self._tasks(), self._buckets(state, size)
        # The same for ``tasks`` that ``writers`` gave.
        writers = buckets * math.ceil(tasks / buckets)
        dealt = rows if writers == tasks else rows.repartition(writers, *self.keys)
        seen = Observation()
        return self._write_base(state, dealt.observe(seen, *_read_counts(), F.count(F.lit(1)).alias("inserted")).drop(COPIES), buckets, seen)

    def _write_base(self, state: State, rows: DataFrame, buckets: int, seen: Observation, touched: list[int] | None = None) -> State:
        """Write ``rows`` as the new base, or as its ``touched`` buckets, bucketed by the key.

        A base bucketed by its key is merged with the next full extract, or
        anti-joined with a large delta, without being shuffled again.
        """
        version = self._next(state)
        name = self._new_name(version, "base")
        draft, path = f"{name}_draft", f"{self.path}/{name}"
        writer = rows.withColumn(SLOT, self._slot(buckets)).write.format("parquet")
        writer = writer.partitionBy(SLOT).bucketBy(buckets, *self.keys).sortBy(*self.keys)
        for option, value in BASE_FILES.items():
            writer = writer.option(option.format(key=self.keys[0]), value)
        writer.option("path", path).saveAsTable(draft)
        rows.sparkSession.sql(f"DROP TABLE `{draft}`")  # the files stay
        written = self._written(path)
        gone = set(written if touched is None else touched)
        kept = {} if touched is None else {f: [n for n in slots if n not in gone] for f, slots in state.slots.items()}
        replaced = [f"{f}/{SLOT}={n}" for f, slots in state.slots.items() for n in slots if n in gone]
        size = 0 if touched is None else state.base_bytes - sum(folder_bytes(f"{self.path}/{f}") for f in replaced)
        return self._commit(
            replace(
                state,
                version=version,
                base=name,
                base_bytes=size + folder_bytes(path),
                base_last_seq=state.last_seq,
                buckets=buckets,
                slots={**{f: slots for f, slots in kept.items() if slots}, name: written},
                deltas=(),
                delta_bytes=0,
                counts={"replaced": 0, "stale": 0, **state.counts, **_filled(seen)},
            ),
            state,
        )

    def _written(self, path: str) -> list[int]:
        """The buckets that have a folder."""
        return sorted(int(name.split("=")[1]) for name in folder_names(path) if name.startswith(f"{SLOT}="))

    def new_bad_folder(self) -> str:
        """Name of a folder for records set aside."""
        return self._new_name(self._next(self.create()), "bad")

    def _new_name(self, version: int, kind: str) -> str:
        return f"{self.spec.name}_{kind}_{version:012d}_{uuid.uuid4().hex[:8]}"



def _read_counts() -> list[Column]:
    return [F.coalesce(F.sum(COPIES), F.lit(0)).alias("read"), F.count(F.lit(1)).alias("landed")]


def _filled(seen: Observation) -> dict[str, int]:
    """The numbers that the writing job has counted on its way."""
    return {name: int(value) for name, value in seen.get.items()}
