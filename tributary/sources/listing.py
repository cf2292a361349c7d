"""Landed pages of the data-set listing, and the choice of data sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tributary.storage import work_folder

PLUGIN = "PluginId"
LINK = "DownloadLink"
NEXT_PAGE = "NextPageUrl"
# Written by whoever landed a page: the address that it was read from.
URL = "Url"


def read_pages(spark: SparkSession, path: str, items: str) -> DataFrame:
    """Landed JSON pages, one per file, as ``(file, items, url, next_page)``.

    ``items`` names the field that holds a page's array, ``Url`` the address that
    a page was read from; the first page, which no other names, may lack it.
    """
    item = f"array<struct<{PLUGIN}:string,{LINK}:string>>"
    schema = f"`{items}` {item}, {URL} string, {NEXT_PAGE} string"
    pages = spark.read.schema(schema).json(path, multiLine=True, mode="FAILFAST")
    absent = F.raise_error(F.concat(F.lit(f"no {items} in "), F.col("_metadata.file_path")))
    return pages.select(
        F.col("_metadata.file_path").alias("file"),
        F.coalesce(F.col(f"`{items}`"), absent).alias("items"),
        F.col(URL).alias("url"),
        F.col(NEXT_PAGE).alias("next_page"),
    )


def pages_in_order(pages: DataFrame) -> DataFrame:
    """Pages with ``page``, their number in the chain of addresses, from 1, whatever the files' names.

    The number is found from the end: every page points at the next, and each
    round doubles the reach of all pointers at once, so a chain of a million
    pages takes twenty rounds. One page, the last, must have no next page, every
    address named must be there once, and every page must lead to the last one;
    a gap, a fork or a ring is an error. Of pages landed without addresses the
    files' names, with leading zeros, give the order, and the last must be last.
    """
    links = _stored(pages.select("file", F.coalesce("url", "file").alias("url"), F.col("next_page").alias("to")))
    total, last, known = links.agg(F.count(F.lit(1)), F.count_if(F.col("to").isNull()), F.count_distinct("url")).first()
    if not total:
        raise ValueError("the listing is not complete: no pages")
    if total > 1 and not pages.where("url IS NOT NULL").head(1):
        return _pages_by_name(pages)
    if known < total:
        raise ValueError("the listing has two pages of one address")
    # A pointer and the steps it takes; past the last page it is NULL.
    reach = links.select("file", "url", "to", F.lit(1).cast("bigint").alias("steps"))
    absent = reach.join(links.select(F.col("url").alias("there")), F.col("to") == F.col("there"), "left_anti").where("to IS NOT NULL").first()
    if absent:
        raise ValueError(f"the listing is not complete: {absent['to']}")
    if last != 1:
        raise ValueError(f"the listing has {last} last pages")
    for _ in range(max(1, (total - 1).bit_length())):
        there = reach.select(F.col("url").alias("there"), F.col("to").alias("beyond"), F.col("steps").alias("more"))
        joined = reach.join(there, F.col("to") == F.col("there"), "left")
        steps = F.col("steps") + F.coalesce("more", F.lit(0))
        reach = _stored(joined.select("file", "url", F.col("beyond").alias("to"), steps.alias("steps")))
    # Whatever is not done after so many rounds goes in a ring.
    if reach.where("to IS NOT NULL").head(1):
        raise ValueError("the listing's pages form a ring")
    if reach.select("steps").distinct().count() < total:
        raise ValueError("the listing's pages fork: two name the same next page")
    numbered = reach.select(F.col("file").alias("_file"), (F.lit(total + 1) - F.col("steps")).alias("page"))
    return pages.join(numbered, F.col("file") == F.col("_file")).drop("_file")


def _pages_by_name(pages: DataFrame) -> DataFrame:
    # As many narrow rows as pages.
    numbers = pages.select(F.col("file").alias("_file"), F.row_number().over(Window.orderBy("file")).cast("bigint").alias("page"), "next_page")
    numbers = _stored(numbers)
    open_end = numbers.agg(F.max(F.struct("page", "next_page")).alias("last")).first()["last"]["next_page"]
    if open_end is not None or numbers.where("next_page IS NULL").count() > 1:
        raise ValueError(f"the listing is not complete: {open_end or 'several last pages'}")
    return pages.join(numbers.drop("next_page"), F.col("file") == F.col("_file")).drop("_file")


def _stored(rows: DataFrame) -> DataFrame:
    """Few narrow rows, written so that rounds do not pile up plans."""
    path = work_folder(rows.sparkSession, "pages")
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def read_listing(pages: DataFrame) -> DataFrame:
    """The items of all pages as ``(page, position, plugin, link)``."""
    items = pages.select("file", "page", F.posexplode("items").alias("position", "item"))
    unnamed = F.raise_error(F.concat(F.lit(f"an item without {PLUGIN} in "), F.col("file")))
    plugin = F.coalesce(F.col(f"item.{PLUGIN}"), unnamed).alias("plugin")
    return items.select("page", "position", plugin, F.col(f"item.{LINK}").alias("link"))


def resolve_links(listing: DataFrame) -> DataFrame:
    """``(plugin, link)``; a plugin listed twice has the link listed last."""
    last = F.max_by("link", F.struct("page", "position")).alias("link")
    return listing.groupBy("plugin").agg(last)


def select_data_sets(registry: DataFrame, links: DataFrame, mode: str) -> DataFrame:
    """``(plugin, table, link)`` of a mode; a data set without a link is an error."""
    missing = F.raise_error(F.concat(F.lit("no link for data set "), F.col("plugin")))
    return (
        registry.where(F.col("mode") == mode)
        .join(links, "plugin", "left")
        .select("plugin", "table", F.coalesce("link", missing).alias("link"))
    )
