import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.helpers import put_extract, unpacked
from tributary.schemas import NUMBER, TableSpec
from tributary.sources.extract import (
    field_count,
    keyed_rows,
    scan_csv,
    scan_records,
    short_rows,
    typed_rows,
    write_csv,
)

THREE = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("a", T.StringType()), T.StructField("b", T.StringType())]
)
EDGES = (
    '1,"",x\n'
    '2,,"a ""q"" b"\n'
    '3,"l1\nl2, c\r\nl3",back\\slash\n'
    '4,  sp  ,"t,u",EXTRA,"E,2"\n'
    '6,"end\\",z\n'
)
EDGE_ROWS = [
    (1, None, "x"),
    (2, None, 'a "q" b'),
    (3, "l1\nl2, c\r\nl3", "back\\slash"),
    (4, "  sp  ", "t,u"),
    (6, "end\\", "z"),
]


def rows_of(frame):
    return [tuple(r) for r in frame.orderBy("id").collect()]


def raw_records(spark, tmp_path, body, schema=THREE):
    put_extract(f"{tmp_path}/in/e.zip", body)
    return scan_records(unpacked(spark, f"{tmp_path}/in"), schema)


def test_edge_rows_from_an_archive(spark, tmp_path):
    rows = typed_rows(raw_records(spark, tmp_path, EDGES), THREE)
    assert rows_of(rows.select("id", "a", "b")) == EDGE_ROWS
    assert [r[0] for r in rows.orderBy("row").select("id").collect()] == [1, 2, 3, 4, 6]


def test_edge_rows_from_a_csv_file(spark, tmp_path):
    (tmp_path / "e.csv").write_bytes(("wrong,names,here,x,y\n" + EDGES).encode())
    rows = typed_rows(scan_csv(spark, f"{tmp_path}/e.csv", THREE), THREE)
    assert rows_of(rows) == EDGE_ROWS


@pytest.mark.parametrize("line", ["5,short", "", "5", '5,"a,b"'])
def test_short_rows_fail_the_load(spark, tmp_path, line):
    raw = raw_records(spark, tmp_path, f"1,a,b\n{line}\n2,a,b,c\n")
    assert short_rows(raw, THREE).count() == 1
    with pytest.raises(Exception, match="fewer than 3 fields"):
        typed_rows(raw, THREE).collect()


def test_short_rows_in_a_csv_file(spark, tmp_path):
    (tmp_path / "e.csv").write_text('h,h,h\n1,a,\n2,"a,b"\n3,a,,\n4,a,b,c\n5\n')
    raw = scan_csv(spark, f"{tmp_path}/e.csv", THREE)
    assert sorted(r["id"] for r in short_rows(raw, THREE).collect()) == ["2", "5"]
    assert short_rows(raw, THREE).count() == 2
    with pytest.raises(Exception, match="fewer than 3 fields"):
        typed_rows(raw, THREE).collect()


def test_long_rows_with_an_empty_last_field_are_kept(spark, tmp_path):
    rows = typed_rows(raw_records(spark, tmp_path, "1,a,,more\n2,b,\n"), THREE)
    assert rows_of(rows.select("id", "a", "b")) == [(1, "a", None), (2, "b", None)]


def test_field_count(spark):
    texts = {"": 1, "a": 1, "a,b": 2, '"a,b",c': 2, '"a ""x, y"" b",,': 3, '"l1\nl2,",z': 2}
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    found = {r[0]: r[1] for r in frame.select("t", field_count(F.col("t"))).collect()}
    assert found == texts


def test_field_count_of_a_very_long_field(spark):
    frame = spark.range(1).select(F.concat(F.lit('"'), F.repeat(F.lit('a""b,'), 200_000), F.lit('",x')).alias("t"))
    assert frame.select(field_count(F.col("t"))).first()[0] == 2


def test_bad_value_and_null_key_fail(spark, tmp_path):
    with pytest.raises(Exception, match="column id: not a bigint: x,a,b"):
        typed_rows(raw_records(spark, tmp_path, "x,a,b\n"), THREE).collect()
    spec = TableSpec("t", ("id",), THREE)
    with pytest.raises(Exception, match="NULL in key column id"):
        keyed_rows(raw_records(spark, tmp_path / "2", ",a,b\n"), spec).collect()


def test_csv_export_reads_back(spark, tmp_path):
    schema = T.StructType(
        [
            T.StructField("id", T.LongType()),
            T.StructField("t", T.StringType()),
            T.StructField("n", NUMBER),
            T.StructField("at", T.TimestampNTZType()),
            T.StructField("ok", T.BooleanType()),
        ]
    )
    source = spark.sql(
        """SELECT * FROM VALUES
        (1L, ' lead, "q"\n\\x ', 1.500000001BD, TIMESTAMP_NTZ'2020-01-02 03:04:05.678901', true),
        (2L, '', -0.1BD, NULL, NULL), (3L, '#no comment', NULL, TIMESTAMP_NTZ'1969-12-31 23:59:59', false)
        AS v(id, t, n, at, ok)"""
    ).select("id", "t", F.col("n").cast(NUMBER), "at", "ok")
    write_csv(source, f"{tmp_path}/out")
    back = typed_rows(scan_csv(spark, f"{tmp_path}/out", schema), schema)
    wanted = source.withColumn("t", F.nullif("t", F.lit("")))
    assert rows_of(back) == rows_of(wanted)
