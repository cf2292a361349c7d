import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tributary.operators.keys import duplicate_keys, null_keys, require_keys
from tributary.operators.upsert import ERROR, drop_stale, last_wins, merge, without_keys



def upsert(base, delta, keys):
    """What a table with a pending delta reads."""
    return without_keys(base, delta, keys).unionByName(delta)


DDL = "k1 bigint, k2 string, v string, n int"
KEYS = ["k1", "k2"]


def frame(spark, rows, ddl=DDL):
    return spark.createDataFrame(rows, ddl)


def as_set(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


keyed = st.dictionaries(
    st.tuples(st.integers(0, 5), st.sampled_from("ab")),
    st.tuples(st.none() | st.sampled_from("xyz"), st.none() | st.integers(0, 9)),
    max_size=8,
)
some = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@some
@given(base=keyed, delta=keyed)
def test_upsert_replaces_and_inserts_whole_rows(spark, base, delta):
    def flat(d):
        return [(*k, *v) for k, v in d.items()]

    b, d = frame(spark, flat(base)), frame(spark, flat(delta))
    wanted = set(flat({**base, **delta}))
    once = upsert(b, d, KEYS)
    assert as_set(once) == wanted
    assert as_set(upsert(once, d, KEYS)) == wanted
    assert as_set(upsert(b.limit(0), d, KEYS)) == set(flat(delta))
    with_seq = [x.withColumn("_seq", F.lit(s).cast("bigint")) for x, s in ((b, 1), (d, 2))]
    assert as_set(merge(*with_seq, KEYS, "_seq").drop("_seq")) == wanted


def test_later_sequence_stays(spark):
    ddl = "k bigint, v string, _seq bigint"
    base = frame(spark, [(1, "old", 5), (2, "old", 1), (3, "old", 2)], ddl)
    delta = frame(spark, [(1, "late", 3), (2, "new", 3), (3, "same", 2), (4, "added", 3)], ddl)
    wanted = {(1, "old", 5), (2, "new", 3), (3, "same", 2), (4, "added", 3)}
    assert as_set(merge(base, delta, ["k"], "_seq")) == wanted
    assert as_set(upsert(base, drop_stale(base, delta, ["k"], "_seq"), ["k"])) == wanted


def test_last_wins_keeps_the_nulls_of_the_winner(spark):
    rows = frame(spark, [(1, "a", "x", 1), (1, "a", None, 3), (1, "a", "z", 2), (2, "b", "y", 1)])
    assert as_set(last_wins(rows, KEYS, ["n"]).select("k1", "k2", "v")) == {(1, "a", None), (2, "b", "y")}


def test_duplicates_are_an_error_on_request(spark):
    rows = frame(spark, [(1, "a", "x", 1), (1, "a", "y", 2), (2, "b", "y", 1)])
    with pytest.raises(Exception, match="key occurs twice in an extract: 1, a"):
        last_wins(rows, KEYS, ["n"], ERROR).collect()
    for read in (lambda found: found.count(), lambda found: found.select("v").collect()):
        with pytest.raises(Exception, match="key occurs twice"):
            read(last_wins(rows, KEYS, ["n"], ERROR))
    assert last_wins(rows.where("n = 1"), KEYS, ["n"], ERROR).count() == 2
    # Once per extract is no duplicate.
    assert as_set(last_wins(rows, KEYS, ["n"], ERROR, "n").select("k1", "v")) == {(1, "y"), (2, "y")}
    again = rows.unionByName(rows.limit(1))
    with pytest.raises(Exception, match="key occurs twice"):
        last_wins(again, KEYS, ["n"], ERROR, "n").collect()
    with pytest.raises(ValueError):
        last_wins(rows, KEYS, ["n"], "first")


def test_key_checks(spark):
    rows = frame(spark, [(1, "a", "x", 1), (1, "a", "y", 2), (None, "b", "y", 1), (3, None, "y", 1), (4, "d", None, 1)])
    assert as_set(duplicate_keys(rows, KEYS)) == {(1, "a", 2)}
    assert null_keys(rows, KEYS).count() == 2
    with pytest.raises(Exception, match="NULL in key column"):
        require_keys(rows, KEYS).collect()
    assert require_keys(rows.dropna(subset=KEYS), KEYS).count() == 3


def test_a_key_with_a_third_of_all_rows(spark):
    """Copies of a hot key are merged before the shuffle."""
    rows = spark.range(0, 300_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("at"),
        F.repeat(F.lit("x"), 20).alias("v"),
    )
    kept = last_wins(rows, ["k"], ["at"])
    assert kept.count() == 200_001
    assert kept.where("k = -1").first()["at"] == 299_997
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max") > plan.index("Exchange")
    assert "Window" not in plan
