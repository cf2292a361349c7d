import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.helpers import put_extract, put_zip, unpacked
from tributary.sources.archive import archive_paths, read_blocks, unpack
from tributary.sources.export import csv_records, write_archives
from tributary.sources.extract import scan_records, typed_rows


def test_archives_are_listed_without_reading_them(spark, tmp_path):
    put_extract(f"{tmp_path}/in/b.zip", "1\n")
    put_extract(f"{tmp_path}/in/a.zip", "2\n")
    put_extract(f"{tmp_path}/in/deeper/C.ZIP", "3\n")
    listed = archive_paths(spark, f"{tmp_path}/in")
    assert sorted(r["path"].rsplit("/", 1)[1] for r in listed.collect()) == ["C.ZIP", "a.zip", "b.zip"]
    assert archive_paths(spark, f"{tmp_path}/in/a.zip").count() == 1
    assert "content" not in listed._jdf.queryExecution().executedPlan().toString()


def test_other_files_among_archives_fail(spark, tmp_path):
    put_extract(f"{tmp_path}/in/a.zip", "1\n")
    (tmp_path / "in" / "part-2.zip.tmp").write_text("no archive")
    for read in (lambda rows: rows.count(), lambda rows: rows.select("length").collect()):
        with pytest.raises(Exception, match="not a zip archive"):
            read(archive_paths(spark, f"{tmp_path}/in"))


@pytest.mark.parametrize("end", ["", "\n"])
@pytest.mark.parametrize("before", ["", '5" pipe,'])
def test_a_field_of_any_length_loads_with_or_without_a_last_newline(spark, tmp_path, before, end):
    put_extract(f"{tmp_path}/in/x.zip", f"1,a\n{before}{'y' * 200_000}{end}")
    assert [len(r["record"]) for r in unpacked(spark, f"{tmp_path}/in").orderBy("row").collect()][0] == 3
    assert unpacked(spark, f"{tmp_path}/in").where(F.length("record") >= 200_000).count() == 1


def test_rows_of_more_columns_than_the_parser_takes(spark, tmp_path):
    wide = ",".join(f'"c,{i}"' if i % 3 else str(i) for i in range(1_000_100))
    put_extract(f"{tmp_path}/in/x.zip", f'7,"a ""q"", b",{wide}\n8,c,d\n')
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("t", T.StringType())])
    rows = typed_rows(scan_records(unpacked(spark, f"{tmp_path}/in"), schema), schema)
    assert sorted((r["id"], r["t"]) for r in rows.collect()) == [(7, 'a "q", b'), (8, "c")]


@pytest.mark.parametrize(
    "entries,message", [({}, "Invalid position"), ({"a.csv": "h\n1", "b.csv": "h\n2"}, "2 entries in the archive")]
)
def test_other_than_one_entry_fails(spark, tmp_path, entries, message):
    put_zip(f"{tmp_path}/in/x.zip", entries)
    with pytest.raises(Exception, match=message):
        unpacked(spark, f"{tmp_path}/in").count()


def test_rows_are_numbered_in_file_order(spark, tmp_path):
    put_extract(f"{tmp_path}/in/x.zip", "".join(f'{i},"a\n{"x" * 50}"\n' for i in range(20_000)))
    rows = unpacked(spark, f"{tmp_path}/in").select("row", F.split("record", ",")[0].cast("long").alias("id"))
    assert rows.count() == 20_000
    assert rows.where("row <> id").count() == 0


def test_records_of_many_megabytes(spark, tmp_path):
    put_extract(f"{tmp_path}/in/x.zip", "".join(f'{i},"{"y, " * 2_000_000}"\n' for i in range(4)))
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("t", T.StringType())])
    rows = typed_rows(scan_records(unpacked(spark, f"{tmp_path}/in"), schema), schema)
    found = rows.select("row", "id", F.length("t").alias("size"))
    assert sorted(tuple(r) for r in found.collect()) == [(i, i, 6_000_000) for i in range(4)]


def test_header_only_archive_has_no_records(spark, tmp_path):
    put_extract(f"{tmp_path}/in/x.zip", "")
    assert unpacked(spark, f"{tmp_path}/in").count() == 0


def test_not_utf8_fails(spark, tmp_path):
    put_zip(f"{tmp_path}/in/x.zip", {"x.csv": b"h\n\xc3\x28,1\n"})
    with pytest.raises(Exception, match="utf-8"):
        unpacked(spark, f"{tmp_path}/in").count()


def test_every_archive_has_its_own_task(spark, tmp_path):
    for i in range(6):
        put_extract(f"{tmp_path}/in/{i}.zip", f"{i}\n")
    archives = archive_paths(spark, f"{tmp_path}/in").select(
        F.lit(1).cast("bigint").alias("seq"), F.lit(1).cast("bigint").alias("part"), "path", "length"
    )
    folder = unpack(archives)
    files = read_blocks(spark, folder).select(F.input_file_name().alias("f")).distinct()
    assert files.count() == 6


def test_written_archives_unpack_to_the_same_records(spark, tmp_path):
    rows = spark.range(1000).select("id", F.concat(F.lit('é "'), "id", F.lit('",\n')).alias("t"))
    text = csv_records(rows).repartition(3)
    assert write_archives(text, f"{tmp_path}/in", rows.columns) == 1000
    back = unpacked(spark, f"{tmp_path}/in").select("record")
    assert back.exceptAll(text).isEmpty() and text.exceptAll(back).isEmpty()
