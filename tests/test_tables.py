import os
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.helpers import plan, settings
from tributary.operators.upsert import merge
from tributary.plans.load import create_tables
from tributary.schemas import TABLES, table_spec
from tributary.sources.tables import KeyedTable, Runs, one_step
from tributary.storage import create_json, file_names

SPEC = table_spec("things", ["a", "b"], {"a": T.LongType(), "b": T.StringType(), "v": T.StringType()})


def rows(spark, values, seq):
    return spark.createDataFrame([(a, b, v, seq) for a, b, v in values], "a bigint, b string, v string, _seq bigint")


def many(spark, first, last, text, seq):
    return spark.range(first, last).select(
        F.col("id").alias("a"),
        F.lit("x").alias("b"),
        F.lit(text).alias("v"),
        F.lit(seq).cast("bigint").alias("_seq"),
    )


def content(table):
    found = [tuple(r) for r in table.read().collect()]
    assert len(found) == len(set(found))
    return set(found)


def test_create_leaves_what_exists(spark, tmp_path):
    tables = create_tables(spark, str(tmp_path))
    assert sorted(tables) == sorted(TABLES)
    users = tables["users"]
    assert users.read().count() == 0 and len(users.read().columns) == users.spec.width == 11
    user = users.spec.empty(spark).schema.fieldNames()
    one = spark.range(1).select(*[F.lit(None).cast(users.spec.schema[c].dataType).alias(c) for c in user])
    users.land(one.withColumns({"user_id": F.lit(7).cast("bigint"), "_seq": F.lit(1).cast("bigint")}), 1, 1)
    again = create_tables(spark, str(tmp_path))["users"]
    assert [r["user_id"] for r in again.read().collect()] == [7]


def test_reading_an_absent_table_fails(spark, tmp_path):
    with pytest.raises(LookupError, match="things does not exist"):
        KeyedTable(spark, str(tmp_path), SPEC).read()


def test_small_deltas_are_kept_until_they_grow(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), SPEC, pending_share=0.9)
    table.land(many(spark, 0, 1000, "base", 1), 1, 1)
    first = table.land(rows(spark, [(1, "x", "new"), (5000, "y", "added")], 2), 2, 2)
    second = table.land(rows(spark, [(1, "x", None)], 3), 3, 3)
    assert (len(first.deltas), len(second.deltas)) == (1, 2) and first.base == second.base
    found = content(table)
    assert len(found) == 1001
    assert {(1, "x", None), (5000, "y", "added"), (2, "x", "base")} <= found
    folded = table.fold()
    assert folded.deltas == () and folded.base != second.base
    assert content(table) == found
    assert table.fold() == folded


def test_named_columns_only_are_read(spark, tmp_path):
    wide = table_spec("wide", ["a"], {"a": T.LongType(), "b": T.StringType(), "v": T.StringType()})
    table = KeyedTable(spark, str(tmp_path), wide, pending_share=1e9)
    for seq in (1, 2, 3):
        table.land(rows(spark, [(1, "x", f"v{seq}"), (seq + 1, "x", "w")], seq), seq, seq)
    found = table.read("v")
    assert sorted(r["v"] for r in found.collect()) == ["v3", "w", "w", "w"]
    scans = re.findall(r"ReadSchema: struct<(.*)>", plan(found, "formatted"))
    assert len(scans) == 3 and not any("b:string" in scan for scan in scans)


def test_large_input_is_merged_at_once(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), SPEC)
    table.land(many(spark, 0, 1000, "base", 1), 1, 1, 10)
    table.land(rows(spark, [(3, "x", "pending"), (4, "x", "pending")], 2), 2, 2, 0)
    state = table.land(many(spark, 4, 2000, "full", 3), 3, 3, 1 << 20)
    assert state.deltas == ()
    found = content(table)
    assert len(found) == 2000
    assert {(2, "x", "base"), (3, "x", "pending"), (4, "x", "full"), (1999, "x", "full")} <= found


def test_rows_of_an_older_extract_do_not_replace_newer_ones(spark, tmp_path):
    for share, size in ((0.0, None), (1e9, None), (1e9, 1), (0.0, 1 << 20)):
        table = KeyedTable(spark, f"{tmp_path}/{share}-{size}", SPEC, pending_share=share)
        table.land(rows(spark, [(1, "x", "seq5"), (2, "x", "seq5")], 5), 5, 5, size)
        table.land(rows(spark, [(3, "x", "seq9")], 9), 9, 9, size)
        table.land(rows(spark, [(1, "x", "seq3"), (3, "x", "seq3"), (4, "x", "seq3")], 3), 3, 3, size)
        table.land(rows(spark, [(4, "x", "seq4"), (2, "x", "seq4")], 4), 4, 4, size)
        wanted = {(1, "x", "seq5"), (2, "x", "seq5"), (3, "x", "seq9"), (4, "x", "seq4")}
        assert content(table) == wanted
        table.fold()
        assert content(table) == wanted


def test_landing_the_same_extract_again_replaces_its_rows(spark, tmp_path):
    for size in (None, 0):
        table = KeyedTable(spark, f"{tmp_path}/{size}", SPEC, pending_share=1e9)
        for text in ("first", "second", "third"):
            table.land(rows(spark, [(1, "x", text)], 1), 1, 1, size)
        assert content(table) == {(1, "x", "third")}


def test_a_repeated_micro_batch_is_skipped(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), SPEC)
    table.land(rows(spark, [(1, "x", "a")], 1), 1, 1, source="s", batch=0)
    after = table.land(rows(spark, [(1, "x", "b")], 2), 2, 2, source="s", batch=1)
    again = table.land(rows(spark, [(1, "x", "c")], 3), 3, 3, source="s", batch=1)
    assert again == after and content(table) == {(1, "x", "b")}
    table.land(rows(spark, [(1, "x", "d")], 4), 4, 4, source="other", batch=0)
    assert content(table) == {(1, "x", "d")}


def test_a_failed_load_changes_nothing(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), SPEC)
    table.land(rows(spark, [(1, "x", "kept")], 1), 1, 1)
    before = table.state()
    bad = rows(spark, [(1, "x", "lost"), (2, "x", "lost")], 2).withColumn(
        "v", F.when(F.col("a") == 2, F.raise_error(F.lit("broken"))).otherwise(F.col("v"))
    )
    for size in (0, 1 << 20):
        with pytest.raises(Exception, match="broken"):
            table.land(bad, 2, 2, size)
    assert table.state() == before and content(table) == {(1, "x", "kept")}


def test_another_writer_is_noticed(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), SPEC)
    state = table.create()
    create_json(f"{table.path}/_commits", f"{state.version + 1:012d}.json", {})
    with pytest.raises(FileExistsError):
        table._commit(type(state)(version=state.version + 1), state)


def test_an_older_reader_keeps_its_rows(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), SPEC)
    table.land(rows(spark, [(1, "x", "old")], 1), 1, 1)
    before = table.read()
    table.land(rows(spark, [(1, "x", "new")], 2), 2, 2)
    assert [r["v"] for r in before.collect()] == ["old"]
    assert content(table) == {(1, "x", "new")}


def test_older_versions_are_removed_on_request(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), SPEC, pending_share=1e9)
    table.land(many(spark, 0, 100, "base", 1), 1, 1)
    first = table.state().base
    table.land(many(spark, 0, 100, "new", 2), 2, 2)  # keys of all buckets
    (delta,) = table.state().deltas
    before = content(table)
    assert table.remove_older() == [] and content(table) == before
    table.fold()
    os.mkdir(f"{table.path}/things_base_under_way")
    reader = table.read()
    assert table.remove_older(keep=2) == [] and content(table) == before
    assert table.remove_older() == sorted([first, delta])
    assert content(table) == before and {tuple(r) for r in reader.collect()} == before
    found = sorted(os.listdir(table.path))
    assert found == sorted(["_commits", table.state().base, "things_base_under_way"])
    table.land(rows(spark, [(1, "x", "newer")], 3), 3, 3)
    assert (1, "x", "newer") in content(table)


def test_a_new_session_finds_the_buckets(spark, tmp_path):
    KeyedTable(spark, str(tmp_path), SPEC, bucket_bytes=100).land(many(spark, 0, 500, "v", 1), 1, 1, 450)
    table = KeyedTable(spark, str(tmp_path), SPEC)
    state = table.state()
    assert state.buckets == 5
    spark.sql(f"DROP TABLE IF EXISTS `{state.base}`")
    assert len(content(table)) == 500
    counted = table.read().groupBy("a", "b").count()
    assert "Exchange" not in plan(counted) and counted.count() == 500


@pytest.mark.parametrize("buckets", [3, 8, 20])
def test_only_deltas_are_moved(spark, tmp_path, buckets):
    """Whatever the number of buckets beside the session's eight partitions."""
    table = KeyedTable(spark, str(tmp_path), SPEC, bucket_bytes=100, pending_share=1e9)
    with settings(spark, spark__sql__shuffle__partitions=str(buckets)):
        assert table.land(many(spark, 0, 500, "v", 1), 1, 1, 100 * buckets).buckets == buckets
    table = KeyedTable(spark, str(tmp_path), SPEC, pending_share=1e9)
    none = {"spark__sql__autoBroadcastJoinThreshold": "-1", "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1"}
    for seq in (2, 3):
        state = table.land(rows(spark, [(1, "x", f"new {seq}"), (900 + seq, "x", "added")], seq), seq, seq, 0)
        with settings(spark, **none):
            assert base_stays(plan(table.read(), "simple"))
        text = plan(table.read(), "simple")
        assert "BroadcastHashJoin" in text and base_stays(text)
    with settings(spark, **none):
        delta = table._pending(state, table.stored.fieldNames()).repartition(state.buckets, *table.keys)
        base = table._base(state).select(*table.stored.fieldNames())
        assert base_stays(plan(merge(base, delta, table.keys, "_seq"), "simple"))
    before = content(table)
    folded = table.fold()
    assert folded.buckets == buckets and content(table) == before and len(before) == 502
    new = [folder for folder in folded.folders if folder.startswith(folded.base)]
    assert new and all(len(parquet_files(f"{table.path}/{folder}")) == 1 for folder in new)


def parquet_files(folder):
    return [f for f in file_names(folder) if f.endswith(".parquet")]


def base_stays(text):
    """Whether no exchange lies between the base's bucketed scan and its join."""
    lines = text.splitlines()
    at = next(n for n, line in enumerate(lines) if "FileScan" in line and "things_base" in line)
    above = [line for line in lines[at - 2 : at]]
    return "Exchange" not in "".join(above)


def test_a_small_base_does_not_hold_a_large_extract_back(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), SPEC)
    state = table.land(rows(spark, [(1, "x", "first")], 1), 1, 1, 10)
    assert state.buckets == 1
    large = 1 << 30
    buckets = table._buckets(state, large)
    assert buckets == 32  # more than the session's partitions
    merged = table._merged(state, many(spark, 0, 500, "full", 2), buckets)
    assert "SinglePartition" not in plan(merged, "simple")
    assert table.land(many(spark, 0, 500, "full", 2), 2, 2, large).buckets >= buckets
    assert len(content(table)) == 500


def test_many_small_batches_keep_few_folders(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), SPEC, pending_share=1e9)
    table.land(many(spark, 0, 100, "base", 1), 1, 1)
    most = 0
    for seq in range(2, 202):
        new = [(seq, "x", f"v{seq}"), (seq % 7, "x", f"again {seq}")]
        state = table.land(rows(spark, new, seq).coalesce(1), seq, seq)
        most = max(most, len(state.deltas))
    assert most < 20
    found = content(table)
    assert (201, "x", "v201") in found and (200 % 7, "x", "again 200") in found and (201 % 7, "x", "again 201") in found
    assert len(found) == 202


def test_a_path_with_a_quote(spark, tmp_path):
    table = KeyedTable(spark, f"{tmp_path}/it's", SPEC)
    table.land(rows(spark, [(1, "x", "v")], 1), 1, 1)
    spark.sql(f"DROP TABLE IF EXISTS `{table.state().base}`")
    assert content(KeyedTable(spark, f"{tmp_path}/it's", SPEC)) == {(1, "x", "v")}


# --- buckets that stay, lookups, runs of several tables, counts


def keys_of_bucket(spark, buckets, wanted, number):
    """Some keys that Spark deals to the bucket ``wanted``."""
    dealt = many(spark, 0, 50_000, "v", 1).where(F.pmod(F.hash("a", "b"), F.lit(buckets)) == wanted)
    return [r["a"] for r in dealt.orderBy("a").limit(number).collect()]


def test_files_lie_in_the_bucket_that_the_hash_says(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), SPEC, bucket_bytes=100)
    state = table.land(many(spark, 0, 2000, "v", 1), 1, 1, 700)
    assert state.buckets == 7 and state.slots == {state.base: list(range(7))}
    for folder in state.folders:
        slot = int(folder.split("=")[1])
        assert all(f"_{slot:05d}.c000" in f for f in parquet_files(f"{table.path}/{folder}"))


def test_only_touched_buckets_are_written_again(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), SPEC, bucket_bytes=100, pending_share=1e9)
    with settings(spark, spark__sql__shuffle__partitions="64"):
        first = table.land(many(spark, 0, 20_000, "base", 1), 1, 1, 6400)
    assert first.buckets == 64
    table = KeyedTable(spark, str(tmp_path), SPEC, pending_share=1e9)
    some = keys_of_bucket(spark, 64, 17, 5)
    new = [(a, "x", "new") for a in some[:4]]
    table.land(rows(spark, new, 2), 2, 2, 0)
    before = content(table)
    state = table.state()
    merged = plan(table._merged(state, table._pending(state, table.stored.fieldNames()), 64, table._touched(state)), "formatted")
    assert re.search(r"PartitionFilters: \[.*_slot#\d+ (=|IN) \(?17\)?", merged) or "_slot" in re.search(r"PartitionFilters: .*", merged)[0]
    folded = table.fold()
    assert table._touched(state) == [17]
    assert folded.slots == {first.base: [n for n in range(64) if n != 17], folded.base: [17]}
    assert len(parquet_files(f"{table.path}/{folded.base}/_slot=17")) == 1 and not parquet_files(f"{table.path}/{folded.base}")
    assert content(table) == before and (some[0], "x", "new") in before and (some[4], "x", "base") in before
    assert folded.counts == {"read": 0, "landed": 0, "inserted": 0, "replaced": 4, "stale": 0}
    assert "Exchange" not in plan(table.read().groupBy("a", "b").count())

    # What later versions no longer read goes, bucket by bucket.
    assert table.remove_older() == sorted([f"{first.base}/_slot=17", *state.deltas])
    spark.sql(f"DROP TABLE IF EXISTS `{folded.base}`")
    assert content(KeyedTable(spark, str(tmp_path), SPEC)) == before
    sizes = sum(os.path.getsize(f"{table.path}/{f}/{n}") for f in folded.folders for n in os.listdir(f"{table.path}/{f}"))
    assert abs(folded.base_bytes - sizes) < 64


def test_folds_of_any_delta_agree_with_a_full_merge(spark, tmp_path):
    tables = [KeyedTable(spark, f"{tmp_path}/{n}", SPEC, bucket_bytes=100, pending_share=1e9) for n in range(2)]
    for table in tables:
        table.land(many(spark, 0, 300, "base", 1), 1, 1, 900)
    tables = [KeyedTable(spark, f"{tmp_path}/{n}", SPEC, pending_share=1e9) for n in range(2)]
    tables[1]._touched = lambda state: None
    for seq, first, last in ((2, 5, 6), (3, 290, 310), (4, 0, 40), (5, 1000, 1002), (6, 5, 6)):
        for table in tables:
            table.land(many(spark, first, last, f"v{seq}", seq), seq, seq)
            table.fold()
        assert content(tables[0]) == content(tables[1])
    counts = [{k: t.state().counts[k] for k in ("inserted", "replaced", "stale")} for t in tables]
    assert counts[0] == counts[1] == {"inserted": 0, "replaced": 1, "stale": 0}


def rows_read(frame):
    """Rows that the scans of the base have given, after the frame was collected."""
    found = [tuple(r) for r in frame.collect()]
    executed = frame._jdf.queryExecution().executedPlan()
    if "AdaptiveSparkPlan" in executed.nodeName():
        executed = executed.executedPlan()
    total, todo = 0, [executed]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if "Scan parquet" in name and "_base_" in node.toString():
            total += node.metrics().get("numOutputRows").get().value()
        if "QueryStage" in name:
            todo.append(node.plan())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found, total


def test_a_lookup_reads_few_rows_of_the_base(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), SPEC, bucket_bytes=100, pending_share=1e9)
    with settings(spark, spark__sql__shuffle__partitions="4"):
        table.land(many(spark, 0, 200_000, "base", 1).repartition(4, "a", "b"), 1, 1, 400)
    wanted = [(5, "x"), (100_000, "x"), (100_000, "absent"), (400_000, "x")]
    keys = spark.createDataFrame(wanted, "a bigint, b string")
    keys.write.parquet(f"{tmp_path}/keys")
    keys = spark.read.parquet(f"{tmp_path}/keys")
    found, read = rows_read(table.rows_of(keys))
    assert sorted(found) == [(5, "x", "base"), (100_000, "x", "base")]
    everything, all_read = rows_read(table.read())
    assert len(everything) == all_read == 200_000 and read <= all_read / 2  # pages of 20,000 rows
    table.land(rows(spark, [(5, "x", "newer"), (400_000, "x", "added"), (7, "x", "other")], 2), 2, 2)
    assert sorted(tuple(r) for r in table.rows_of(keys).collect()) == [(5, "x", "newer"), (100_000, "x", "base"), (400_000, "x", "added")]
    many_keys = spark.range(0, 3000).select(F.col("id").alias("a"), F.lit("x").alias("b"))
    found, read = rows_read(table.rows_of(many_keys))
    assert len(found) == 3000 and read < all_read


def test_an_older_extract_looks_at_its_keys_only(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), SPEC, pending_share=1e9, bucket_bytes=100)
    table.land(many(spark, 0, 1000, "base", 5), 5, 5, 500)
    state = table.land(rows(spark, [(1, "x", "late"), (2, "x", "late"), (5000, "x", "late")], 3), 3, 3)
    assert state.counts == {"read": 3, "landed": 3, "stale": 2}
    assert len(state.deltas) == 1 and content(table) >= {(1, "x", "base"), (5000, "x", "late")}
    assert sorted(os.listdir(table.path)) == sorted(["_commits", state.base, *state.deltas])


def test_counts_tell_what_a_load_did(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), SPEC)
    first = many(spark, 0, 100, "base", 5).withColumn("_copies", F.when(F.col("a") < 10, 3).otherwise(1))
    assert table.land(first, 5, 5, 10).counts == {"read": 120, "landed": 100, "inserted": 100, "replaced": 0, "stale": 0}
    state = table.land(many(spark, 90, 130, "full", 6), 6, 6, 1 << 20)
    assert state.counts == {"read": 40, "landed": 40, "inserted": 30, "replaced": 10, "stale": 0}
    state = table.land(many(spark, 0, 150, "old", 2), 2, 2, 1 << 20)
    assert state.counts == {"read": 150, "landed": 150, "inserted": 20, "replaced": 0, "stale": 130}
    assert table.state().counts == state.counts
    assert table.land(many(spark, 0, 0, "none", 9), 9, 9, 1 << 20).counts["read"] == 0


def test_several_tables_change_in_one_step(spark, tmp_path):
    specs = [SPEC, table_spec("others", ["a"], {"a": T.LongType(), "b": T.StringType(), "v": T.StringType()})]
    tables = [KeyedTable(spark, str(tmp_path), spec) for spec in specs]
    readers = [KeyedTable(spark, str(tmp_path), spec) for spec in specs]
    for table in tables:
        table.create()
        table.land(rows(spark, [(1, "x", "old")], 1), 1, 1)
    before = [t.state() for t in readers]
    with pytest.raises(RuntimeError, match="second table"), one_step(tables):
        tables[0].land(rows(spark, [(1, "x", "new")], 2), 2, 2)
        assert content(tables[0]) == {(1, "x", "new")} and content(readers[0]) == {(1, "x", "old")}
        raise RuntimeError("second table")
    assert [t.state() for t in (*tables, *readers)] == [*before, *before]
    with one_step(tables):
        for table in tables:
            table.land(rows(spark, [(1, "x", "new")], 2), 2, 2)
        assert [t.state() for t in readers] == before
    assert [content(t) for t in readers] == [{(1, "x", "new")}] * 2
    assert tables[0].state().version > before[0].version + 1  # the failed one's number stays used
    with one_step(tables):
        pass
    with pytest.raises(FileExistsError, match="changed by another run"), one_step(tables):
        tables[0].land(rows(spark, [(1, "x", "mine")], 3), 3, 3)
        readers[0].land(rows(spark, [(1, "x", "theirs")], 3), 3, 3)
    assert content(tables[0]) == {(1, "x", "theirs")}


def test_runs_of_different_tables_do_not_disturb_each_other(tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    def publish(name):
        for version in range(1, 40):
            Runs(str(tmp_path)).publish({name: (version - 1 or None, version)})

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(publish, "abcd"))
    number, versions = Runs(str(tmp_path)).newest()
    assert versions == dict.fromkeys("abcd", 39) and number == 4 * 39
