"""From landed files to stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vulnatlas.operators import normalize
from vulnatlas.operators.merging import one_per_key
from vulnatlas.operators.postings import build_postings, write_postings
from vulnatlas.operators.segments import append_segment
from vulnatlas.session import staged
from vulnatlas.sinks.writers import append_new, replace_table
from vulnatlas.sources import advisories, exploits, tables, writeups


def advisory_table(spark: SparkSession, feeds: str | list[str]) -> DataFrame:
    """Advisories of the feeds, the first row of each id in feed order."""
    rows = normalize.normalize_advisories(advisories.read_feeds(spark, feeds), "source_order")
    return one_per_key(rows, "id", "source_order").drop("source_order")


def exploit_table(spark: SparkSession, catalogue: str) -> DataFrame:
    """Exploits of the catalogue, the first row of each id in catalogue order."""
    rows = normalize.valid_exploit_rows(exploits.read_catalogue(spark, catalogue))
    return normalize.normalize_exploits(one_per_key(rows, "id", "source_order"))


def writeup_table(spark: SparkSession, root: str) -> DataFrame:
    return normalize.index_writeups(writeups.read_writeups(spark, root))


def append_advisories(spark: SparkSession, feeds: str | list[str], path: str) -> int:
    """Append the advisories of the feeds that are not stored yet, by year; how many there were."""
    rows = normalize.normalize_advisories(advisories.read_feeds(spark, feeds), "source_order")
    return append_new(rows, path, "id", "source_order", partition_by="year", transient=("source_order",))


def append_indexed(spark: SparkSession, feeds: str | list[str], root: str, **made) -> int:
    """Append the advisories of the feeds that the search index at ``root`` does not hold yet; how many there were.

    ``made`` is how :func:`~vulnatlas.operators.segments.append_segment` makes the index. The parsed rows are staged, as
    an append reads them up to three times.
    """
    rows = normalize.normalize_advisories(advisories.read_feeds(spark, feeds), "source_order")
    with staged(rows, "advisories") as parsed:
        return append_segment(spark, parsed, root, "source_order", transient=("source_order",), **made)


def append_exploits(spark: SparkSession, catalogue: str, path: str) -> int:
    """Append the exploits of the catalogue that are not stored yet; how many there were."""
    rows = normalize.normalize_exploits(exploits.read_catalogue(spark, catalogue), "source_order")
    return append_new(rows, path, "id", "source_order", transient=("source_order",))


def build(
    spark: SparkSession, postings_path: str, feeds: str | list[str] | None = None, catalogue: str | None = None,
    writeup_root: str | None = None, enrichment_dir: str | None = None,
) -> dict[str, DataFrame]:
    """Build every table whose input is given; the others, enrichment included, stay as they are."""
    built = {}
    if feeds:
        built["cves"] = replace_table(advisory_table(spark, feeds), "cves", "id")
        built["cves_postings"] = write_postings(build_postings(built["cves"], stem=True), postings_path)
    if catalogue:
        built["exploits"] = replace_table(exploit_table(spark, catalogue), "exploits", "id")
    if writeup_root:
        built["writeups"] = replace_table(writeup_table(spark, writeup_root), "writeups", "path")
    if enrichment_dir:
        for name, rows in tables.discover_enrichment(spark, enrichment_dir).items():
            built[name] = replace_table(rows, name)
    return built
