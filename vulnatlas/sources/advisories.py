"""Yearly advisory feeds: one JSON document per file with an array of advisories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vulnatlas.operators.limits import first_rows
from vulnatlas.sources.feed_cuts import ITEMS, cut_documents, feed_text

_METRIC = "array<struct<baseSeverity: string, cvssData: struct<baseScore: double, baseSeverity: string, vectorString: string>>>"

ADVISORY_FIELDS = f"""
    id: string, published: string, lastModified: string, sourceIdentifier: string, vulnStatus: string,
    descriptions: array<struct<lang: string, value: string>>,
    metrics: struct<cvssMetricV40: {_METRIC}, cvssMetricV31: {_METRIC},
                    cvssMetricV30: {_METRIC}, cvssMetricV2: {_METRIC}>,
    weaknesses: array<struct<description: array<struct<lang: string, value: string>>>>,
    references: array<struct<url: string, tags: array<string>>>
"""

# First year with a feed of its own, and the feed file name.
FIRST_FEED_YEAR = 2002
FEED_NAME = "nvdcve-2.0-{year}.json.gz"


def feed_glob(directory: str, first: int, last: int) -> str:
    """Feed files of the years ``first`` to ``last``, both included.

    Advisories of years before the first feed are in that feed. A year whose file has not landed is left out.
    """
    years = ",".join(map(str, range(max(first, FIRST_FEED_YEAR), last + 1)))
    if not years:
        raise ValueError(f"no feed covers the years {first} to {last}")
    return f"{directory.rstrip('/')}/{FEED_NAME.format(year='{' + years + '}')}"


def read_feeds(spark: SparkSession, paths: str | list[str], limit: int | None = None) -> DataFrame:
    """One row per advisory with an id: ``cve`` typed, ``raw`` as landed, and its ``source_order``.

    A feed is a single compressed document, so a file is read by one task, which cuts it into small
    ones; these are spread out and parsed right after. Undecodable bytes are replaced. A document that
    is not JSON fails the read, as a skipped one would lose a year.
    """
    items = parse_items(feed_items(feed_text(spark.read, paths)))
    return first_rows(items, limit, "source_order")


def feed_items(feeds: DataFrame) -> DataFrame:
    """``(source_order, raw)`` per item of feed documents read by :func:`feed_text`: place in the feeds and JSON text.

    Feeds are ordered by when they landed, those of one moment by full path. ``raw`` is the parsed item
    written again: the same values, with keys in order and numbers in their shortest form.
    """
    parsed = F.from_json("document", f"array<struct<{ITEMS}: array<variant>>>", {"mode": "FAILFAST"})
    cut = cut_documents(feeds).select("landed", "file", "n", F.explode(parsed).alias("feed"))
    items = cut.select("landed", "file", F.col("n").alias("first"), F.posexplode(f"feed.{ITEMS}").alias("n", "item"))
    place = (F.col("first") + F.col("n")).cast("int").alias("n")
    return items.select(F.struct("landed", "file", place).alias("source_order"), F.to_json("item").alias("raw"))


def parse_items(raw: DataFrame) -> DataFrame:
    """Feed items in JSON column ``raw`` with the typed ``cve``; items without an id are dropped."""
    item = F.from_json("raw", f"cve struct<{ADVISORY_FIELDS}>")
    return raw.select("source_order", item["cve"].alias("cve"), "raw").filter("cve.id <> ''")
