import random
import re
from datetime import datetime
from decimal import ROUND_CEILING, ROUND_FLOOR, ROUND_HALF_UP, Context, Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.helpers import plan, settings
from tributary.functions.casts import cast_text
from tributary.functions.grades import grade
from tributary.schemas import BOOL, INT, LONG, NUMBER, TABLES, WHEN, table_spec
from tributary.sources.extract import field_count, keyed_rows, scan_records


def value(spark, text, kind, name="c"):
    frame = spark.createDataFrame([(text, "kept")], f"{name} string, other string")
    row = cast_text(frame, T.StructType([T.StructField(name, kind)])).first()
    assert row["other"] == "kept"
    return row[name]


@pytest.mark.parametrize(
    "text,wanted",
    [(w, True) for w in ("t", "TRUE", " yes ", "on", "1", "tr", "Y")]
    + [(w, False) for w in ("f", "False", "no", "off", "0", "of", "\tN\n")],
)
def test_boolean_words(spark, text, wanted):
    assert value(spark, text, BOOL, "b") is wanted


@pytest.mark.parametrize("text", ["o", "maybe", "truee", "2", "10", "-"])
def test_other_words_fail(spark, text):
    with pytest.raises(Exception, match="column b: not a boolean"):
        value(spark, text, BOOL, "b")


@pytest.mark.parametrize("text,wanted", [("12", 12), (" -7 ", -7), ("+5", 5), ("9223372036854775807", 2**63 - 1)])
def test_integers(spark, text, wanted):
    assert value(spark, text, LONG, "i") == wanted


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("text,kind", [("1.5", LONG), ("x", INT), ("9223372036854775808", LONG), ("3000000000", INT)])
def test_bad_integers_fail_with_and_without_ansi(spark, text, kind, ansi):
    with settings(spark, spark__sql__ansi__enabled=ansi), pytest.raises(Exception, match="column i: not a"):
        value(spark, text, kind, "i")


@pytest.mark.parametrize(
    "text,wanted",
    [("1.5", "1.5"), (" 2 ", "2"), ("1e3", "1000"), ("-0.000000001", "-0.000000001"), ("1.10000000000", "1.1"),
     ("99999999999.999999999", "99999999999.999999999"), ("0.3333333333", "0.3333333333"), ("1e-10", "0.0000000001"),
     ("123456789012", "123456789012"), ("0.123456789012345678000", "0.123456789012345678"), ("15e-18", "0.000000000000000015"), ("1.5e-8", "0.000000015"), ("2.5e-10", "0.00000000025"),
     ("1.1234567891e-3", "0.0011234567891"), ("1.5e-17", "0.000000000000000015"), ("100e-20", "0.000000000000000001"), ("0.10e-17", "0.000000000000000001"),
     ("0e-40", "0"), ("0.0000000000000000001e1", "0.000000000000000001"), ("-.5E-3", "-0.0005"), ("12345.6789e+10", "123456789000000"), ("1.5E+3", "1500"),
     ("99999999999999999999.999999999999999999", "99999999999999999999.999999999999999999")],
)
def test_decimals(spark, text, wanted):
    assert value(spark, text, NUMBER, "d") == Decimal(wanted)


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("text", ["0.0000000000000000001", "1e-19", "2.5e-18", "101e-20", "0.11e-17", "1.1234567891e-9", "1e-99999999999", "0.00000000000000000011e1", "1.5e-18", "1e-100", "100000000000000000000", "0.9999999999999999999", "abc", "NaN"])
def test_decimals_are_never_rounded(spark, text, ansi):
    with settings(spark, spark__sql__ansi__enabled=ansi), pytest.raises(Exception, match="column d: not a decimal"):
        value(spark, text, NUMBER, "d")


@pytest.mark.parametrize(
    "text,wanted",
    [
        ("2020-01-02T03:04:05Z", datetime(2020, 1, 2, 3, 4, 5)),
        ("2020-01-02 03:04:05.678+05:00", datetime(2020, 1, 2, 3, 4, 5, 678000)),
        ("2020-01-02", datetime(2020, 1, 2)),
        ("2020-01-02T03:04:05.1234567Z", datetime(2020, 1, 2, 3, 4, 5, 123457)),
        ("2020-01-02T03:04:05.1234561Z", datetime(2020, 1, 2, 3, 4, 5, 123456)),
        ("2020-12-31T23:59:59.9999999", datetime(2021, 1, 1)),
        ("2020-01-05 00:00:00.1234567", datetime(2020, 1, 5, 0, 0, 0, 123457)),
        ("2020-1-5 00:00:00.1234567", datetime(2020, 1, 5, 0, 0, 0, 123457)),
        (" 2020-1-5 ", datetime(2020, 1, 5)),
    ],
)
def test_timestamps(spark, text, wanted):
    for zone in ("UTC", "America/Toronto"):
        with settings(spark, spark__sql__session__timeZone=zone):
            assert value(spark, text, WHEN, "t") == wanted


@pytest.mark.parametrize("text", ["yesterday-ish", "2020", "2020-01", " 2020-01 ", "   2020  ", "+02020-01", "10:11:12", "2020-13-01", "2020-02-30 10:00:00"])
def test_bad_timestamp_fails(spark, text):
    with pytest.raises(Exception, match="column t: not a timestamp"):
        value(spark, text, WHEN, "t")


def test_nulls_stay(spark):
    for spec in TABLES.values():
        empty = spark.range(1).select(*[F.lit(None).cast("string").alias(c) for c in spec.columns])
        typed = cast_text(empty, spec.schema)
        assert [f.dataType for f in typed.schema.fields] == [f.dataType for f in spec.schema.fields]
        assert set(typed.first()) == {None}


def test_generated_code_stays_short_enough_to_be_compiled(spark):
    """The JVM leaves methods of more than 8,000 bytes to its interpreter."""
    for spec in TABLES.values():
        records = spark.createDataFrame([(1, 1, 1, "a")], "seq long, part long, row long, record string")
        text = plan(keyed_rows(scan_records(records, spec.schema), spec), "codegen")
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
        assert sizes and max(sizes) < 8000, spec.name


@pytest.mark.parametrize(
    "n,d,wanted",
    [("1", "8", "0.13"), ("-1", "8", "-0.13"), ("1", "0", "0.00"), (None, "0", "0.00"), (None, "1", None),
     ("1", None, None), ("4.9999996", "1000", "0.00"), ("5", "1000", "0.01"), ("0.0049", "0.98", "0.01"),
     ("99999999999", "0.000000003", "33333333333000000000.00"), ("0.004999999999999999", "1", "0.00"),
     ("-0.004999999999999999", "1", "-0.00"), ("0.005", "1", "0.01"), ("0.995", "1", "1.00"), ("0.994999999999999999", "1", "0.99"),
     ("1234567890123.999999999999999999", "200", "6172839450.62"), ("3.014999999999999999", "-1", "-3.01"),
     ("12345678901234567890.5", "1", "12345678901234567890.50"),
     ("50000000000000000000", "99999999999999999999", "0.50"), ("499999999999999999.999999999999999999", "99999999999999999999.999999999999999999", "0.00"),
     ("500000000000000000", "99999999999999999999.999999999999999999", "0.01"), ("-149999999999999999.999999999999999999", "10000000000000000000", "-0.01"),
     ("-150000000000000000", "10000000000000000000", "-0.02"), ("99499999999999999999.004999999999999999", "99999999999999999999", "0.99"),
     ("99499999999999999999.005", "99999999999999999999", "1.00"),
     ("14999999999999999.999999999999999999", "1000000000000000000", "0.01"), ("15000000000000000", "1000000000000000000", "0.02")],
)
def test_grade(spark, n, d, wanted):
    frame = spark.createDataFrame([(n, d)], "n string, d string")
    found = frame.select(grade(F.col("n").cast(NUMBER), F.col("d").cast(NUMBER))).first()[0]
    assert found == (None if wanted is None else Decimal(wanted))


def test_grades_are_exact_for_every_denominator(spark):
    dice, exact, pairs = random.Random(1), Context(prec=80), []
    for digits in range(1, 39):
        for _ in range(12):
            d = Decimal(dice.randrange(10 ** (digits - 1), 10**digits)).scaleb(-18, exact)
            half = exact.multiply(d, Decimal(2 * dice.randrange(0, 120) + 1).scaleb(-200 // 200, exact)) / 20
            n = half.quantize(Decimal("1e-18"), dice.choice([ROUND_FLOOR, ROUND_CEILING]), exact)
            pairs.append((n * dice.choice([1, -1]), d))
    fits = [(n, d) for n, d in pairs if abs(n) < 10**20]
    frame = spark.createDataFrame([(str(n), str(d)) for n, d in fits], "n string, d string")
    found = frame.select(grade(F.col("n").cast(NUMBER), F.col("d").cast(NUMBER))).collect()
    wanted = [exact.divide(n, d).quantize(Decimal("0.01"), ROUND_HALF_UP, exact) for n, d in fits]
    assert [r[0] for r in found] == wanted and len(fits) > 300


def test_a_grade_divides_once(spark, tmp_path):
    """Numerator, denominator and quotient stand once in the plan, so that none is computed again in a branch."""
    spark.createDataFrame([("1", "8")], "n string, d string").write.parquet(f"{tmp_path}/pairs")
    pairs = spark.read.parquet(f"{tmp_path}/pairs").select(F.col("n").cast(NUMBER).alias("n"), F.col("d").cast(NUMBER).alias("d"))
    text = plan(pairs.select(grade(F.col("n"), F.col("d")).alias("grade")), "simple")
    assert len(re.findall(r"\(n#\d+L? / d#\d+L?\)", text)) == 1


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("read", [lambda r: r.count(), lambda r: r.select("t").collect(), lambda r: r.collect()])
@pytest.mark.parametrize("record,about", [("1,maybe,x", "not a boolean"), ("1,t", "fewer than 3 fields"), (",t,x", "NULL in key")])
def test_no_choice_of_columns_removes_a_check(spark, record, about, read, ansi):
    spec = table_spec("small", ["id"], {"id": LONG, "ok": BOOL, "t": T.StringType()})
    records = spark.createDataFrame([(1, 1, 1, "7,t,x"), (1, 1, 2, record)], "seq long, part long, row long, record string")
    with settings(spark, spark__sql__ansi__enabled=ansi), pytest.raises(Exception, match=about):
        read(keyed_rows(scan_records(records, spec.schema), spec))


def test_only_texts_that_may_be_too_long_are_matched(spark):
    """A decimal of few places is told by its length; no pattern is run over it."""
    records = spark.createDataFrame([(1, 1, 1, "a")], "seq long, part long, row long, record string")
    text = plan(keyed_rows(scan_records(records, TABLES["grade_results"].schema), TABLES["grade_results"]), "extended")
    assert not re.search(r"rlike\(points_numerator", text.lower()) and "instr(points_numerator" in text.lower()


@pytest.mark.parametrize("record,wanted", [("", 1), ("a", 1), ("a,b", 2), ('"a,b",c', 2), ('"a ""b,"" c",,"d\n,e"', 3), (",,", 3), ('"",""', 2)])
def test_field_count(spark, record, wanted):
    frame = spark.createDataFrame([(record,)], "record string")
    assert frame.select(field_count(F.col("record"))).first()[0] == wanted
