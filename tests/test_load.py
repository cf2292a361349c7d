import json
import os
import time
from uuid import uuid4

import pytest

from tests.helpers import plan, put_extract, put_pages, put_zip, settings, unpacked
from tributary.plans.load import create_tables, load, quarantined, register_views, turns
from tributary.plans.reports import enrollment_report, grade_report, preview
from tributary.schemas import DATA_SETS, DIFFERENTIAL, FULL, TABLES
from tributary.sources.archive import archive_paths, batch_records, read_blocks, unpack
from tributary.session import FREED, working_session
from tributary.sources.extract import scan_records, split_rows
from tributary.sources.tables import KeyedTable

EXTRACTS = {
    "org_units": '10,Org,Course,"Maths, first",M1,2020-01-01T00:00:00.000Z,,True,2019-12-01T10:11:12.345Z,new column\n'
    "11,Org,Course,Physics,P1,,,False,\n",
    "users": "1,ann,a-1,Ann,,Lee,True,Org,ann@x,,2020-02-02T00:00:00Z\n2,bob,b-1,Bob,J,Ray,0,Org,,,\n",
    "grade_objects": "5,10,,Quiz,Numeric,,,,False,False,False,10,True,False,,50.5,0,0,,,,,,Q,1,1\n"
    "6,11,,Lab,Numeric,,,,f,f,f,0,t,f,,,,,,,,,,,,\n",
    "grade_results": '5,10,1,8.125,10,,,True,False,2020-03-03T00:00:00Z,2,"good\nwork",\n'
    "6,11,1,3,0,,,True,False,,,,\n5,10,2,,10,,,True,False,,,,\n5,10,3,1,2,,,True,False,,,,\n",
    "user_enrollments": "10,1,Student,2020-01-05T00:00:00Z,Direct\n11,1,Student,,\n10,2,Teacher,,\n99,2,Teacher,,\n",
}


def publish(folder, extracts, mode=FULL, skip=()):
    links = []
    for plugin, table, published in DATA_SETS:
        if published == mode and table in extracts and table not in skip:
            links.append((plugin, put_extract(f"{folder}/{table}.zip", extracts[table])))
    return put_pages(f"{folder}/listing", [links[:2], links[2:]])


def run(spark, tmp_path, extracts=EXTRACTS, mode=FULL, name="in", **options):
    listing = publish(f"{tmp_path}/{name}", {**EXTRACTS, **extracts} if mode == FULL else extracts, mode)
    load(spark, listing, "Objects", f"{tmp_path}/tables", mode, **options)
    return create_tables(spark, f"{tmp_path}/tables")


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_full_load_and_reports(spark, tmp_path, ansi):
    with settings(spark, spark__sql__ansi__enabled=ansi):
        full_load_and_reports(spark, tmp_path)


def full_load_and_reports(spark, tmp_path):
    t = run(spark, tmp_path)
    assert {n: x.read().count() for n, x in t.items()} == {
        "org_units": 2, "users": 2, "grade_objects": 2, "grade_results": 4, "user_enrollments": 4,
    }
    comments = t["grade_results"].read().where("comments is not null").select("comments")
    assert rows(comments) == [("good\nwork",)]
    grades = grade_report(*(t[n].read() for n in ("grade_results", "users", "org_units", "grade_objects")))
    assert [(a, b, c, None if g is None else str(g)) for a, b, c, g in rows(grades)] == [
        ("ann", "Maths, first", "Quiz", "0.81"),
        ("ann", "Physics", "Lab", "0.00"),
        ("bob", "Maths, first", "Quiz", None),
    ]
    listed = enrollment_report(t["user_enrollments"].read(), t["users"].read(), t["org_units"].read())
    assert [r[:5] for r in rows(listed)] == [
        ("Ann", "Lee", "ann", "Student", "Maths, first"), ("Ann", "Lee", "ann", "Student", "Physics"),
        ("Bob", "Ray", "bob", "Teacher", "Maths, first"),
    ]
    assert preview(listed, 2).count() == 2 and len(preview(listed, ordered=True).collect()) == 3
    register_views(t)
    joined = spark.sql("SELECT count(*) AS n FROM grade_results r JOIN users u ON r.user_id = u.user_id")
    assert joined.first()["n"] == 3


def test_no_records_are_left_behind(spark, tmp_path, monkeypatch):
    shared = f"{tmp_path}/shared"
    monkeypatch.setattr("tributary.sources.archive.work_folder", lambda spark, purpose: f"{shared}/{purpose}-{uuid4()}")
    run(spark, tmp_path)
    with pytest.raises(Exception, match="not a bigint"):
        run(spark, tmp_path, {"users": "x,,,,,,,,,,\n"}, name="bad")
    assert os.listdir(shared) == []


def test_second_full_load_keeps_absent_rows_and_replaces_the_rest(spark, tmp_path):
    run(spark, tmp_path)
    t = run(spark, tmp_path, {"users": "2,bobby,,,,,,,,,\n3,cy,,,,,,,,,\n"}, name="second")
    found = rows(t["users"].read().select("user_id", "user_name", "first_name", "is_active"))
    assert found == [(1, "ann", "Ann", True), (2, "bobby", None, None), (3, "cy", None, None)]


def test_differential_load_touches_enrolments_only(spark, tmp_path):
    before = run(spark, tmp_path)
    versions = {n: x.state().version for n, x in before.items()}
    delta = {"user_enrollments": "10,1,Grader,2020-01-06T00:00:00Z,Direct\n12,5,Student,,\n"}
    t = run(spark, tmp_path, delta, DIFFERENTIAL, "diff")
    changed = {n for n, x in t.items() if x.state().version != versions[n]}
    assert changed == {"user_enrollments"}
    found = rows(t["user_enrollments"].read().select("org_unit_id", "user_id", "role_name"))
    assert found == [(10, 1, "Grader"), (10, 2, "Teacher"), (11, 1, "Student"), (12, 5, "Student"), (99, 2, "Teacher")]


def test_last_copy_of_a_key_wins_or_fails(spark, tmp_path):
    twice = {"users": "1,first,,,,,,,,,\n2,b,,,,,,,,,\n1,last,,,,,,,,,\n"}
    t = run(spark, tmp_path, twice)
    assert rows(t["users"].read().select("user_id", "user_name")) == [(1, "last"), (2, "b")]
    with pytest.raises(Exception, match="key occurs twice in an extract: 1"):
        run(spark, tmp_path, twice, name="again", on_duplicate="error")


def test_archives_of_a_folder_are_one_extract_in_name_order(spark, tmp_path):
    listing = publish(f"{tmp_path}/in", EXTRACTS, skip=("users",))
    for number, name in enumerate(["one", "two", "three"]):
        put_extract(f"{tmp_path}/in/users/part-{number}.zip", f"1,{name},,,,,,,,,\n{10 + number},x,,,,,,,,,\n")
    plugin = next(p for p, t, m in DATA_SETS if t == "users")
    put_pages(f"{tmp_path}/in/listing/more", [[(plugin, f"{tmp_path}/in/users")]])
    more, second = json.loads((tmp_path / "in/listing/more/page-0000.json").read_text()), tmp_path / "in/listing/page-0001.json"
    (tmp_path / "in/listing/more/page-0000.json").write_text(json.dumps({**more, "Url": "page/2"}))
    second.write_text(json.dumps({**json.loads(second.read_text()), "NextPageUrl": "page/2"}))
    listing = f"{listing}{{,/more}}"
    load(spark, listing, "Objects", f"{tmp_path}/tables", FULL)
    users = create_tables(spark, f"{tmp_path}/tables")["users"].read()
    assert rows(users.select("user_id", "user_name")) == [(1, "three"), (10, "x"), (11, "x"), (12, "x")]


def test_empty_extracts_load(spark, tmp_path):
    t = run(spark, tmp_path, {name: "" for name in TABLES})
    assert all(x.read().count() == 0 for x in t.values())
    t = run(spark, tmp_path, name="filled")
    assert t["users"].read().count() == 2
    t = run(spark, tmp_path, {"users": ""}, name="empty")
    assert t["users"].read().count() == 2


@pytest.mark.parametrize(
    "extracts,message",
    [
        ({"users": "1,ann\n"}, "fewer than 11 fields"),
        ({"users": "1,a,,,,,,,,,\n\n"}, "fewer than 11 fields"),
        ({"users": ",ann,,,,,,,,,\n"}, "NULL in key column user_id"),
        ({"users": "x,ann,,,,,,,,,\n"}, "column user_id: not a bigint"),
        ({"grade_results": "1,,3,,,,,,,,,,\n"}, "NULL in key column org_unit_id"),
        ({"org_units": "1,,,,,,,maybe,\n"}, "column is_active: not a boolean"),
    ],
)
def test_bad_extracts_leave_the_table_as_it_was(spark, tmp_path, extracts, message):
    (table,) = extracts
    before = run(spark, tmp_path)[table].state()
    with pytest.raises(Exception, match=message):
        run(spark, tmp_path, extracts, name="bad")
    assert create_tables(spark, f"{tmp_path}/tables")[table].state() == before


def test_nothing_is_loaded_without_all_links(spark, tmp_path):
    listing = publish(f"{tmp_path}/in", EXTRACTS, skip=("user_enrollments",))
    with pytest.raises(Exception, match="no link for data set 533f84c8"):
        load(spark, listing, "Objects", f"{tmp_path}/tables", FULL)
    assert all(t.state().version == 1 for t in create_tables(spark, f"{tmp_path}/tables").values())


def test_archive_with_two_entries_fails(spark, tmp_path):
    listing = publish(f"{tmp_path}/in", EXTRACTS)
    put_zip(f"{tmp_path}/in/users.zip", {"a.csv": "h\n", "b.csv": "h\n"})
    with pytest.raises(Exception, match="2 entries"):
        load(spark, listing, "Objects", f"{tmp_path}/tables", FULL)


BAD_USERS = "1,ann,,,,,True,,,,\n2,bob\nx,cy,,,,,,,,,\n,di,,,,,,,,,\n5,ed,,,,,maybe,,,,\n1,last,,,,,,,,,\n\n6,fay,,,,,,,,,2020-99-01\n"


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_records_are_set_aside_in_the_pass_that_loads(spark, tmp_path, ansi):
    with settings(spark, spark__sql__ansi__enabled=ansi):
        t = run(spark, tmp_path, {"users": BAD_USERS}, on_bad="quarantine")["users"]
        assert rows(t.read().select("user_id", "user_name")) == [(1, "last")]
        found = sorted((r.row, r.reason, r.record) for r in quarantined(t).collect())
        assert found == [
            (1, "fewer than 11 fields", "2,bob"),
            (2, "column user_id: not a bigint", "x,cy,,,,,,,,,"),
            (3, "NULL in key column user_id", ",di,,,,,,,,,"),
            (4, "column is_active: not a boolean", "5,ed,,,,,maybe,,,,"),
            (6, "fewer than 11 fields", ""),
            (7, "column signup_date: not a timestamp_ntz", "6,fay,,,,,,,,,2020-99-01"),
        ]
        assert t.state().counts == {"bad": 6, "read": 2, "landed": 1, "inserted": 1, "replaced": 0, "stale": 0}
        again = run(spark, tmp_path, {"users": "3,new,,,,,,,,,\n4\n"}, name="again", on_bad="quarantine")["users"]
        assert quarantined(again).count() == 7 and again.read().count() == 2
        assert not [f for f in again.state().bad if os.path.exists(f"{again.path}/{f}/_bad=false")]


def test_a_load_without_bad_records_keeps_no_folder(spark, tmp_path):
    t = run(spark, tmp_path, on_bad="quarantine")
    assert all(x.state().bad == () and x.state().counts["bad"] == 0 and quarantined(x).count() == 0 for x in t.values())
    with pytest.raises(ValueError, match="on_bad"):
        run(spark, tmp_path, name="other", on_bad="skip")


def test_records_are_parsed_once(spark, tmp_path):
    put_extract(f"{tmp_path}/in/e.zip", BAD_USERS)
    raw = scan_records(unpacked(spark, f"{tmp_path}/in"), TABLES["users"].schema)
    sound, bad, number = split_rows(raw, TABLES["users"], f"{tmp_path}/out")
    assert (sound.count(), bad.count(), number) == (2, 6, 6)
    for frame in (sound, bad):
        assert "from_csv" not in plan(frame) and "FileScan parquet" in plan(frame, "simple")


def test_a_failure_on_one_table_leaves_all_as_they_were(spark, tmp_path):
    before = {n: x.state() for n, x in run(spark, tmp_path).items()}
    bad = {"org_units": "12,Org,,Chemistry,C1,,,,\n", "user_enrollments": "10,x,Student,,\n"}
    with pytest.raises(Exception, match="column user_id: not a bigint"):
        run(spark, tmp_path, bad, name="bad")
    after = create_tables(spark, f"{tmp_path}/tables")
    assert {n: x.state() for n, x in after.items()} == before
    assert after["org_units"].read().count() == 2
    run(spark, tmp_path, {"org_units": bad["org_units"]}, name="good")
    assert after["org_units"].read().count() == 3


def test_duplicates_are_judged_by_batches_of_lines(spark, tmp_path):
    """As the publisher's loader does: an error within 10,000 lines, the last one across."""
    def users(first, second):
        lines = [f"{100 + i},u{i},,,,,,,,,\n" for i in range(20_500)]
        lines[first], lines[second] = "1,first,,,,,,,,,\n", '1,"last\nof two lines",,,,,,,,,\n'
        return {"users": "".join(lines)}

    t = run(spark, tmp_path, users(9_999, 10_000), on_duplicate="batch")["users"]
    assert rows(t.read().where("user_id = 1").select("user_name")) == [("last\nof two lines",)]
    with pytest.raises(Exception, match="key occurs twice in an extract: 1"):
        run(spark, tmp_path, users(0, 9_999), name="same", on_duplicate="batch")
    # A record of two lines moves all that follow by one.
    early = users(10_000, 5)["users"].replace("u10001,", "u,", 1)
    t = run(spark, tmp_path, {"users": early.replace("100,u0,", '100,"u\n0",', 1)}, name="moved", on_duplicate="batch")["users"]
    assert t.state().counts["read"] == 20_500 and rows(t.read().where("user_id = 1").select("user_name")) == [("first",)]


def test_batches_count_the_lines_of_all_parts_before(spark, tmp_path):
    put_extract(f"{tmp_path}/in/a.zip", "1\n2\n" + '"3\n\n"\n' + "4\n")
    put_extract(f"{tmp_path}/in/b.zip", "5\n6\n")
    files = archive_paths(spark, f"{tmp_path}/in").orderBy("path").collect()
    listed = [(7, n, f["path"], f["length"]) for n, f in enumerate(files)]
    archives = spark.createDataFrame(listed, "seq bigint, part bigint, path string, length bigint")
    found = batch_records(read_blocks(spark, unpack(archives)), 3).orderBy("part", "row").collect()
    assert [(r.record, *r.batch) for r in found] == [("1", 7, 0), ("2", 7, 0), ('"3\n\n"', 7, 0), ("4", 7, 1), ("5", 7, 2), ("6", 7, 2)]


# --- what a load holds on disk


@pytest.mark.parametrize("on_bad", ["fail", "quarantine"])
def test_evenly_split_archives_are_not_stored_again(spark, tmp_path, monkeypatch, on_bad):
    stored = []
    monkeypatch.setattr("tributary.plans.load.unpack", lambda archives, number: stored.append(number) or unpack(archives, number))
    listing = publish(f"{tmp_path}/in", EXTRACTS, skip=("users",))
    for number in range(20):
        put_extract(f"{tmp_path}/in/users/part-{number:02d}.zip", f"1,u{number:02d},,,,,,,,,\n{number + 10},x,,,,,,,,,\n")
    page = tmp_path / "in/listing/page-0001.json"
    found = json.loads(page.read_text())
    found["Objects"].append({"PluginId": next(p for p, t, m in DATA_SETS if t == "users"), "DownloadLink": f"{tmp_path}/in/users"})
    page.write_text(json.dumps(found))
    load(spark, listing, "Objects", f"{tmp_path}/tables", FULL, on_bad=on_bad)
    users = create_tables(spark, f"{tmp_path}/tables")["users"]
    assert rows(users.read("user_id", "user_name")) == [(1, "u19"), *((n + 10, "x") for n in range(20))]
    assert users.state().counts["read"] == 40
    assert sorted(stored) == [1, 1, 1, 1]  # archives that hold all of a table


def test_rows_of_a_first_base_move_once(spark, tmp_path, monkeypatch):
    """Whatever the number of buckets beside the session's eight partitions; no shuffle files are kept."""
    plans, settled, write = [], [], KeyedTable._write_base

    def write_base(self, state, rows, buckets, *more):
        plans.append(plan(rows, "simple").count("hashpartitioning"))
        settled.append(rows.sparkSession.conf.get(FREED))
        return write(self, state, rows, buckets, *more)

    monkeypatch.setattr(KeyedTable, "_write_base", write_base)
    monkeypatch.setattr(KeyedTable, "_buckets", lambda self, state, size: 5)
    t = run(spark, tmp_path)
    assert plans == [1] * 5 and settled == ["true"] * 5
    assert t["grade_results"].state().buckets == 5 and t["grade_results"].read().count() == 4
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"


def test_tables_land_in_turns_bounded_by_the_largest():
    assert turns({"a": 1, "b": 10, "c": 6, "d": 5, "e": 4}, 0) == [["b"], ["c"], ["d", "e", "a"]]
    assert turns({"a": 3, "b": 3}, 0) == [["a"], ["b"]]
    assert turns({"a": 0}, 0) == [["a"]]
    assert turns({"a": 5, "b": 3, "c": 3}, 8) == [["a", "b"], ["c"]]
    assert turns({"a": 5 << 30, "b": 4 << 30, "c": 3 << 20}) == [["a"], ["b", "c"]]
    assert turns({"a": 5 << 20, "b": 4 << 20}) == [["a", "b"]]


def test_a_working_session_keeps_no_shuffle_files(spark, tmp_path):
    def files():
        found = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString("\n")
        return {name for name in found.splitlines() if "/shuffle_" in name}

    with settings(spark, spark__sql__ansi__enabled="false"):
        own = working_session(spark, spark__sql__shuffle__partitions="3")
    assert (own.conf.get("spark.sql.ansi.enabled"), own.conf.get("spark.sql.shuffle.partitions")) == ("false", "3")
    before, until = files(), time.monotonic() + 10
    own.range(100).repartition(3, "id").write.parquet(f"{tmp_path}/out")
    while files() - before and time.monotonic() < until:  # the files go a moment after the query
        time.sleep(0.1)
    assert not files() - before and own.read.parquet(f"{tmp_path}/out").count() == 100
