"""From landed rows to the base tables: one projection per source, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vulnatlas.functions import columns as C
from vulnatlas.sources.writeups import MANIFEST, TEXT_EXTENSIONS

# Score versions in the order they are preferred.
METRIC_PRECEDENCE = ("cvssMetricV40", "cvssMetricV31", "cvssMetricV30", "cvssMetricV2")

# Columns of the base tables. Advisories carry four more (see normalize_advisories).
CVES = ("id", "published", "severity", "cvss", "cwe", "description", "refs", "ref_tags", "source", "status")
EXPLOITS = (
    "id", "description", "date", "author", "type", "platform", "port", "verified", "cves", "tags",
    "markdown", "source", "url",
)
WRITEUPS = ("path", "title", "repo", "size", "ext")


def normalize_advisories(items: DataFrame, *columns: str) -> DataFrame:
    """The ``cves`` table from feed items (column ``cve``), with the vector, the modification time,
    a timestamp and the year beside the base columns. ``columns`` are passed through."""
    items = items.withColumn("metric", C.preferred_metric(F.col("cve.metrics"), METRIC_PRECEDENCE))
    return items.select(
        F.col("cve.id").alias("id"),
        F.col("cve.published").alias("published"),
        C.metric_severity(F.col("metric")).alias("severity"),
        F.col("metric.cvssData.baseScore").alias("cvss"),
        C.first_cwe(F.col("cve.weaknesses")).alias("cwe"),
        C.first_value_in_language(F.col("cve.descriptions")).alias("description"),
        C.reference_urls(F.col("cve.references")).alias("refs"),
        C.reference_tags(F.col("cve.references")).alias("ref_tags"),
        F.col("cve.sourceIdentifier").alias("source"),
        F.col("cve.vulnStatus").alias("status"),
        F.col("metric.cvssData.vectorString").alias("cvss_vector"),
        F.col("cve.lastModified").alias("last_modified"),
        *derived_times(F.col("cve.published")),
        *columns,
    )


def derived_times(published: Column) -> tuple[Column, Column]:
    return (
        F.try_to_timestamp(published).alias("published_ts"),
        C.published_year(published).try_cast("int").alias("year"),
    )


def advisories_from_index(rows: DataFrame) -> DataFrame:
    """The ``cves`` table from advisory index lines."""
    return rows.select(
        "id", "published", "severity", F.col("cvssScore").alias("cvss"), "cwe", "description",
        F.coalesce("references", F.array().cast("array<string>")).alias("refs"),
        F.coalesce("refTags", F.array().cast("array<string>")).alias("ref_tags"),
        "source", "status", F.col("cvssVector").alias("cvss_vector"),
        F.col("lastModified").alias("last_modified"), *derived_times(F.col("published")),
    )


def valid_exploit_rows(catalogue: DataFrame) -> DataFrame:
    """Catalogue rows with a usable numeric id, cast."""
    return catalogue.withColumn("id", F.col("id").try_cast("bigint")).filter("id <> 0")


def normalize_exploits(catalogue: DataFrame, *columns: str) -> DataFrame:
    """The ``exploits`` table from catalogue rows. ``columns`` are passed through."""
    return valid_exploit_rows(catalogue).select(
        "id",
        "description",
        F.col("date_published").alias("date"),
        "author", "type", "platform", "port",
        F.coalesce(F.col("verified") == "1", F.lit(False)).alias("verified"),
        C.cve_codes(F.col("codes")).alias("cves"),
        C.split_list(F.col("tags"), ";").alias("tags"),
        exploit_markdown_path().alias("markdown"),
        exploit_source_path().alias("source"),
        exploit_url().alias("url"),
        *columns,
    )


def exploit_markdown_path() -> Column:
    return F.concat(F.lit(f"{C.MARKDOWN_DIR}/"), "id", F.lit("-"), C.slug(C.or_empty(F.col("description"))), F.lit(".md"))


def exploit_source_path() -> Column:
    return F.concat(F.lit(f"{C.SOURCE_DIR}/"), C.basename(F.col("file")))


def exploit_url() -> Column:
    return F.concat(F.lit(C.EXPLOIT_URL), F.col("id").cast("string"))


def exploit_cards(catalogue: DataFrame) -> DataFrame:
    """``(id, markdown, markdown_body)``: the card text of each exploit and the path it is filed under."""

    def shown(column: str | Column) -> Column:
        value = F.col(column) if isinstance(column, str) else column
        return F.coalesce(value, F.lit("None"))

    return valid_exploit_rows(catalogue).select(
        "id",
        exploit_markdown_path().alias("markdown"),
        F.format_string(
            C.CARD_FORMAT,
            F.col("id").cast("string"),
            *map(shown, ("description", "date_published", "author", "type", "platform", "port", "verified", "tags")),
            F.array_join(C.cve_codes(F.col("codes")), ", "),
            exploit_source_path(),
            exploit_url(),
            F.concat(F.lit(C.RAW_FILE_URL), shown("file")),
        ).alias("markdown_body"),
    )


def index_writeups(files: DataFrame, base: str = "data/writeups") -> DataFrame:
    """The ``writeups`` table from rows ``(path, content, size)``, ``path`` relative to ``base``."""
    name = C.basename(F.col("path"))
    directory = F.regexp_extract("path", "^(.*)/[^/]*$", 1)
    return (
        files.withColumn("ext", C.file_extension(name))
        .filter(F.col("ext").isin(*TEXT_EXTENSIONS) & ~name.startswith(".") & (name != MANIFEST))
        .select(
            F.concat(F.lit(f"{base}/"), "path").alias("path"),
            C.text_title(F.col("content")).alias("title"),
            F.when(directory == "", F.lit(".")).otherwise(directory).alias("repo"),
            "size",
            "ext",
        )
    )
