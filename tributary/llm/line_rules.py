"""Quality rules with the frequency of lines across a host's documents."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.llm.common import stored

SYMBOLS = re.compile(r"[#*$%&|<>]")
DIGITS = re.compile(rb"[0-9]+")
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
WINDOW = 3


def repeated_words(words: list[bytes]) -> int:
    """Words inside a window of three that the text has at least twice."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    seen = Counter(windows)
    marked = np.zeros(len(words) + 1, bool)
    at = np.flatnonzero([seen[w] > 1 for w in windows])
    for shift in range(WINDOW):
        marked[at + shift] = True
    return int(marked.sum())


def line_key(line: bytes) -> int:
    """Hash of a line with case, digits and spacing levelled, as a signed number."""
    plain = b" ".join(DIGITS.sub(b"0", line.lower()).split())
    return xxhash.xxh64_intdigest(plain) - (1 << 63)


def measure(text: str) -> tuple[list[int], dict[int, tuple[int, list[int]]]]:
    """The counts of a text; of each of its levelled lines the words, and the numbers of the lines."""
    raw = text.encode()
    words = raw.split()
    earlier, duplicates, lines = set(), 0, {}
    for number, line in enumerate(raw.split(b"\n")):
        inside = len(line.split())
        if not inside:
            continue
        duplicates += line in earlier
        earlier.add(line)
        key = line_key(line)
        held, at = lines.get(key) or (0, [])
        at.append(number)
        lines[key] = (held + inside, at)
    chars = len(text) - sum(text.count(c) for c in SPACES)
    return [len(words), chars, len(SYMBOLS.findall(text)), duplicates, repeated_words(words)], lines


def measured(docs: DataFrame) -> DataFrame:
    """Counts and levelled lines of every row."""
    pairs = pa.list_(pa.struct([("line", pa.int64()), ("words", pa.int64()), ("at", pa.list_(pa.int32()))]))
    schema = "doc_id bigint, host string, " + ", ".join(f"{c} bigint" for c in COUNTS)
    schema += ", lines array<struct<line: bigint, words: bigint, at: array<int>>>"

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, lines = [], []
            for value in batch.column("text"):
                numbers, found = measure(value.as_py() or "")
                counts.append(numbers)
                lines.append([{"line": k, "words": n, "at": at} for k, (n, at) in found.items()])
            columns = [pa.array(c, pa.int64()) for c in (zip(*counts, strict=True) if counts else [()] * len(COUNTS))]
            columns = [batch.column("doc_id"), batch.column("host"), *columns, pa.array(lines, pairs)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "host", *COUNTS, "lines"])

    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("source").cast("string").alias("host"), F.col("text").cast("string"))
    return texts.mapInArrow(counted, schema)


def line_rules(
    docs: DataFrame,
    least_words: int = 50,
    repeat_percent: int = 50,
    line_docs: int = 20,
    line_share: float = 0.05,
    many_docs: int = 1000,
    least_left: float = 0.5,
) -> DataFrame:
    """Counts and verdict of every row of ``docs`` (``doc_id, text, source``).

    A line is common if more than ``many_docs`` documents of its host (its
    ``source``; a null is a host of its own) hold it, or more than the share
    ``line_share`` of them, though at least ``line_docs`` and one; so the limit
    does not grow with a large host. Case, digits and spacing don't matter. Each
    row is a document. Common lines are removed: ``removed_lines`` has their
    numbers in the text, counted from 0 over what line feeds part, and
    ``without_lines`` cuts them out. A document is depleted, and not
    kept, if less than ``least_left`` of its words is left. Neither are documents
    kept of under ``least_words`` words, a null or empty text among them, or of
    more than ``repeat_percent`` percent words in repeated windows of three.
    Columns beyond the three are not read. An empty table gives an empty table.

    Each document names a line once, and counts are summed before they are
    shuffled, so a line that a third of all rows share costs a row per task.
    """
    rows = stored(measured(docs).withColumn("row", F.monotonically_increasing_id()), "lines")
    lines = rows.select("row", "host", F.inline("lines"))
    counts = lines.groupBy("host", "line").agg(F.count("*").alias("docs")).where(F.col("docs") > line_docs)
    hosts = rows.groupBy("host").agg(F.count("*").alias("of"))
    common = counts.alias("c").join(hosts.alias("h"), F.col("c.host").eqNullSafe(F.col("h.host")))
    common = common.where((F.col("docs") > many_docs) | (F.col("docs") > F.col("of") * line_share)).select("c.host", "c.line")
    on = F.col("l.host").eqNullSafe(F.col("c.host")) & (F.col("l.line") == F.col("c.line"))
    removed = lines.alias("l").join(common.alias("c"), on).groupBy("row")
    numbers = F.array_sort(F.flatten(F.collect_list("at")))
    removed = removed.agg(F.sum("words").alias("removed_words"), numbers.alias("removed_lines"))
    verdict = rows.drop("lines").join(removed, "row", "left")
    left = F.col("n_words") - F.coalesce("removed_words", F.lit(0))
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))
    return verdict.select(
        "doc_id",
        *COUNTS,
        failed.alias("base_failed"),
        (~failed & (left >= least_left * F.col("n_words"))).alias("kept"),
        F.coalesce("removed_words", F.lit(0)).alias("n_removed_words"),
        F.coalesce("removed_lines", F.array().cast("array<int>")).alias("removed_lines"),
    )


@F.arrow_udf(T.StringType())
def without_lines(texts: pa.Array, removed: pa.Array) -> pa.Array:
    """Texts without the lines of these numbers; a null text stays null."""
    left = []
    for text, numbers in zip(texts.to_pylist(), removed.to_pylist(), strict=True):
        if text is not None and numbers:
            gone = set(numbers)
            text = "\n".join(line for i, line in enumerate(text.split("\n")) if i not in gone)
        left.append(text)
    return pa.array(left, pa.string())
