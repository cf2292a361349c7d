"""Mixing sources to target weights by entropy balancing, in built-in functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.common import WORD, stored

#: Rows of one source and size are told apart in groups of about so many.
GROUP_ROWS = 256


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("bigint")


def source_key(source: Column) -> Column:
    """A text that is never null, another one for a null than for any source."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("n"))


def ranked(sources: DataFrame) -> DataFrame:
    """Sources with ``place``, from 0, by code point, null last.

    Sorted by range; a partition's offset comes from the partitions' counts, so
    no task sees all sources.
    """
    placed = sources.orderBy(F.col("source").asc_nulls_last())
    placed = placed.withColumn("part", F.spark_partition_id()).withColumn("nth", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    placed = stored(placed, "sources")
    parts = placed.groupBy("part").agg(F.count("*").alias("rows"))
    # As many rows as partitions.
    before = F.coalesce(F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return placed.join(parts.select("part", before.alias("before")), "part").withColumn("place", F.col("before") + F.col("nth"))


def targets(sources: DataFrame, weights: tuple[float, ...], most: float) -> DataFrame:
    """Sources with ``target``: all sizes shared by weight, none above ``most`` times its own.

    What is above is shared again by weight among the rest until none is above.
    """
    n = len(weights)
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("place") % n + 1).cast("int"))
    rows = stored(ranked(sources).select("key", "source_size", weight.alias("weight")), "weights")
    full = F.col("source_size") * F.lit(float(most))
    level, capped = 0.0, -1
    while True:
        above = full <= F.col("weight") * F.lit(level)
        left = F.sum(F.when(~above, F.col("weight")))
        row = rows.agg(F.sum("source_size"), F.sum(F.when(above, full)), left, F.sum(above.cast("int"))).first()
        if row[2] is None or row[3] == capped:
            break
        level, capped = ((row[0] or 0) - (row[1] or 0.0)) / row[2], row[3]
    return rows.select("key", "source_size", F.least(full, F.col("weight") * F.lit(level)).alias("target"))


def rate(size: Column, most: float) -> Column:
    """Copies wanted of a document: its size, tilted exponentially, at most ``most``."""
    return F.least(F.lit(float(most)), F.exp(F.least(F.col("tilt") * size / F.col("mean"), F.lit(700.0))))


def balance(cells: DataFrame, goals: DataFrame, most: float, rounds: int = 80, tolerance: float = 1e-10) -> DataFrame:
    """The tilt of each source whose rates take its target.

    Minimising the entropy of the rates against one copy of each document, under
    a source's token constraint and rates of at most ``most``, gives rates
    ``min(most, exp(tilt * size))``. The dual is convex; each round sums its
    gradient and curvature over ``cells`` (``key, size, n``) and takes a Newton
    step for all sources at once, or halves the bracket where a step leaves it.
    """
    infinite = F.lit(float("inf"))
    means = cells.groupBy("key").agg((F.sum(F.col("n") * F.col("size")) / F.sum("n")).alias("mean"))
    state = goals.join(means, "key").select(
        "key",
        "target",
        F.greatest("mean", F.lit(1e-9)).alias("mean"),
        # A target at the limit needs every rate there.
        F.when(F.col("target") >= F.col("source_size") * most * (1 - 1e-12), F.lit(1e9)).otherwise(0.0).alias("tilt"),
        (-infinite).alias("low"),
        infinite.alias("high"),
        F.lit(False).alias("done"),
    )
    state = stored(state, "tilts")
    for _ in range(rounds):
        at = rate(F.col("size"), most)
        took = F.col("n") * F.col("size") * at
        bend = F.when(at < most, took * F.col("size") / F.col("mean")).otherwise(0.0)
        sums = cells.where("size > 0").join(state.where("NOT done"), "key").groupBy("key").agg(F.sum(took).alias("took"), F.sum(bend).alias("bend"))
        gap = F.coalesce("took", F.lit(0.0)) - F.col("target")
        both = state.join(sums, "key", "left").withColumn("gap", F.when(F.col("done"), 0.0).otherwise(gap))
        both = both.withColumn("done", F.col("done") | (F.col("tilt") >= 1e9) | (F.abs("gap") <= tolerance * F.greatest("target", F.lit(1.0))))
        both = both.withColumn("low", F.when(F.col("gap") < 0, F.col("tilt")).otherwise(F.col("low")))
        both = both.withColumn("high", F.when(F.col("gap") > 0, F.col("tilt")).otherwise(F.col("high")))
        newton = F.when(F.col("bend") > 0, F.col("tilt") - F.col("gap") / F.col("bend"))
        middle = (
            F.when(F.col("high") == infinite, 2 * F.col("low") + 1)
            .when(F.col("low") == -infinite, 2 * F.col("high") - 1)
            .otherwise((F.col("low") + F.col("high")) / 2)
        )
        inside = newton.isNotNull() & (newton > F.col("low")) & (newton < F.col("high"))
        moved = F.when(F.col("done"), F.col("tilt")).otherwise(F.when(inside, newton).otherwise(middle))
        state = stored(both.select("key", "target", "mean", moved.alias("tilt"), "low", "high", "done"), "tilts")
        if not state.where("NOT done").head(1):
            break
    return state.select("key", "target", "mean", "tilt")


def rounded(cells: DataFrame, tilts: DataFrame, most: float, passes: int = 4) -> DataFrame:
    """Cells with ``base`` copies of each document and one more of ``extra`` documents.

    Running sums over a source's sizes carry what is cut off; then the one size
    that best closes the gap to the target takes more or fewer, a few times.
    A source has at most sqrt(2 * words) distinct sizes.
    """
    rows = cells.join(tilts, "key").withColumn("rate", rate(F.col("size"), most))
    rows = rows.withColumn("base", F.floor("rate")).withColumn("part", F.col("n") * (F.col("rate") - F.col("base")))
    upto = F.sum("part").over(Window.partitionBy("key").orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, 0))
    extra = F.floor(upto + 0.5) - F.floor(upto - F.col("part") + 0.5)
    rows = rows.withColumn("extra", F.greatest(F.lit(0), F.least(extra, F.col("n"))))
    rows = stored(rows.select("key", "size", "n", "target", "rate", "base", "extra"), "cells")
    for _ in range(passes):
        took = F.sum(F.col("size") * (F.col("n") * F.col("base") + F.col("extra")))
        gaps = rows.groupBy("key").agg((F.first("target") - took).alias("gap"))
        more = F.when(F.col("base") >= most, 0).otherwise(F.col("n") - F.col("extra"))
        step = F.greatest(-F.col("extra"), F.least(more, F.round(F.col("gap") / F.col("size")))).cast("bigint")
        rest = F.abs(F.col("gap") - step * F.col("size"))
        better = rows.where("size > 0").join(gaps, "key").select("key", "size", step.alias("step"), rest.alias("rest"), "gap")
        better = better.where("step <> 0 AND rest < abs(gap)").groupBy("key").agg(F.min(F.struct("rest", "size", "step")).alias("best"))
        change = better.select("key", F.col("best.size").alias("size"), F.col("best.step").alias("step"))
        rows = rows.join(change, ["key", "size"], "left").withColumn("extra", F.col("extra") + F.coalesce("step", F.lit(0))).drop("step")
        rows = stored(rows, "cells")
    return rows


def mix(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """How many copies of every row of ``docs`` (``doc_id, text, source``) a mix takes.

    Sources in order of code points, null last, weigh ``weights`` in turn and
    share the words of all documents; a target stops at ``most`` times its
    source's words. Returns ``doc_id, source, size, source_size, target, taken``
    (words, copies counted), ``copies`` and ``rate``. The choice among documents
    of a source and size goes by a hash of id and text, so runs agree; of rows that
    repeat both each counts, and which of them is taken makes no difference.
    Null and empty texts have size 0 and take nothing; other columns are not read.

    The Newton rounds run over counts by source and size. Documents of one source
    and size are chosen in groups by hash, so that no group, however large, has
    to be sorted by one task.
    """
    dice = F.xxhash64(F.col("doc_id"), F.col("text").cast("string")).alias("dice")
    rows = docs.select(F.col("doc_id"), F.col("source").cast("string").alias("source"), n_words(F.col("text")).alias("size"), dice)
    rows = stored(rows.withColumn("key", source_key(F.col("source"))), "sizes")
    cells = stored(rows.groupBy("key", "size").agg(F.count("*").alias("n")), "cells")
    sources = rows.groupBy("key", "source").agg(F.sum("size").alias("source_size"))
    goals = stored(targets(sources, weights, most), "goals")
    plan = rounded(cells, balance(cells, goals, most), most).drop("target")

    groups = F.lit(1) + F.floor(F.col("n") / GROUP_ROWS)
    dealt = rows.join(plan, ["key", "size"]).withColumn("group", F.pmod(F.col("dice"), groups))
    counts = dealt.where("extra > 0 AND extra < n").groupBy("key", "size", "group").agg(F.count("*").alias("rows"), F.first("extra").alias("of"))
    before = F.coalesce(
        F.sum("rows").over(Window.partitionBy("key", "size").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    wanted = counts.select("key", "size", "group", (F.col("of") - before).alias("wanted"))
    nth = F.row_number().over(Window.partitionBy("key", "size", "group").orderBy("dice", "doc_id"))
    chosen = dealt.join(wanted, ["key", "size", "group"], "left").withColumn("nth", nth)
    one_more = F.when(F.col("extra") >= F.col("n"), 1).when(F.col("nth") <= F.coalesce("wanted", F.lit(0)), 1).otherwise(0)
    copies = (F.col("base") + one_more).cast("bigint")
    return chosen.join(goals, "key").select(
        "doc_id", "source", "size", "source_size", "target", (F.col("size") * copies).alias("taken"), copies.alias("copies"), "rate"
    )


def repeat(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """``docs`` with each row as often as the mix takes it, its columns unchanged.

    Rows that share id, source and size get their copies in the order of a hash
    of all their values, so reruns agree.
    """
    taken = [f"_{name}" for name in ("size", "nth", "copies", "id", "source")]
    while set(taken) & set(docs.columns):
        taken = [f"_{name}" for name in taken]
    size, nth, copies, id_, source = taken
    plan = mix(docs, weights, most).select(F.col("doc_id").alias(id_), F.col("source").alias(source), F.col("size").alias(size), F.col("copies").alias(copies))
    plan = plan.withColumn(nth, F.row_number().over(Window.partitionBy(id_, source, size).orderBy(copies)))
    rows = docs.withColumn(size, n_words(F.col("text")))
    rows = rows.withColumn(nth, F.row_number().over(Window.partitionBy("doc_id", "source", size).orderBy(F.xxhash64(*docs.columns))))
    on = rows.doc_id.eqNullSafe(plan[id_]) & rows.source.eqNullSafe(plan[source]) & (rows[size] == plan[size]) & (rows[nth] == plan[nth])
    both = rows.join(plan, on).withColumn(copies, F.explode(F.array_repeat(F.lit(0), F.col(copies).cast("int"))))
    return both.select(*(rows[c] for c in docs.columns))
