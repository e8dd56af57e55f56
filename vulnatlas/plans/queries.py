"""The questions a user asks. Tables in, one DataFrame out; nothing runs until an action."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vulnatlas.operators import matching
from vulnatlas.operators.filters import advisory_filters, any_of, contains
from vulnatlas.operators.limits import first_rows, top_scored
from vulnatlas.operators.links import nested_exploits
from vulnatlas.operators.match_tree import Tree, match_tree
from vulnatlas.operators.normalize import CVES
from vulnatlas.operators.postings import query_tokens

ADVISORY_RESULT = ("id", "published", "severity", "cvss", "cwe", "description")
DEFAULT_LIMIT = 20


def lookup(cves: DataFrame, cve_id: str) -> DataFrame:
    """One advisory by id, in any case; empty if it is not there."""
    row = cves.filter(F.col("id") == cve_id.upper()).select(*CVES)
    return row.withColumnsRenamed({"refs": "references", "ref_tags": "refTags"})


def lookup_exploits(cves: DataFrame, exploits: DataFrame, cve_id: str) -> DataFrame:
    """Nested exploits of one known advisory; empty if there are none or the id is unknown."""
    wanted = cve_id.upper()
    known = cves.filter(F.col("id") == wanted).select(F.col("id").alias("cve_id"))
    named = exploits.filter(F.array_contains("cves", wanted)).withColumn("cves", F.array(F.lit(wanted)))
    return nested_exploits(named).join(known, "cve_id", "left_semi")


def search(
    postings: DataFrame,
    cves: DataFrame,
    terms: str | Iterable[str] | Tree,
    stem: bool = True,
    limit: int | None = DEFAULT_LIMIT,
    **filters,
) -> DataFrame:
    """Advisories that hold all terms, best score first. A term of several words is a phrase.

    Instead of terms, any tree of conditions (:mod:`vulnatlas.operators.match_tree`) may be asked for.

    ``stem`` says whether the postings hold stems; ``filters`` are those of
    :func:`~vulnatlas.operators.filters.advisory_filters`.
    """
    hits = match_terms(postings, terms, stem)
    found = advisory_filters(cves, **filters).join(hits, "id")
    if limit is None:
        return found.select(*ADVISORY_RESULT)
    # The best rows are found by id and score alone, so no descriptions are ranked; those are fetched
    # afterwards for at most `limit` ids, by the same filters, as an id may repeat.
    best = top_scored(found.select("id", "cvss"), limit).select("id").distinct()
    return top_scored(advisory_filters(cves, **filters).select(*ADVISORY_RESULT).join(best, "id"), limit)


def scan_search(
    cves: DataFrame, terms: str | Iterable[str], limit: int | None = DEFAULT_LIMIT, **filters
) -> DataFrame:
    """Search of descriptions where no postings are stored: one scan, no join and no shuffle.

    The other filters go first, so only the rows they leave are tokenised. Words are compared as
    they are, not by stem.
    """
    words = analyzed_terms(cves.sparkSession, terms, stem=False)
    found = advisory_filters(cves, **filters).filter(matching.text_matches(F.col("description"), words))
    return top_scored(found.select(*ADVISORY_RESULT), limit)


def match_terms(postings: DataFrame, terms: str | Iterable[str] | Tree, stem: bool = True) -> DataFrame:
    if isinstance(terms, Tree):
        return match_tree(postings, terms, stem)
    words = analyzed_terms(postings.sparkSession, terms, stem)
    if all(len(word) == 1 for word in words):
        return matching.match_all(postings, [word for (word,) in words])
    return matching.match_terms(postings, words)


def analyzed_terms(spark: SparkSession, terms: str | Iterable[str], stem: bool) -> list[list[str]]:
    terms = [terms] if isinstance(terms, str) else list(terms)
    if sum(map(len, terms)) < 2:
        raise ValueError("search terms need at least two characters")
    words = query_tokens(spark, terms, stem)
    if not all(words):
        raise ValueError(f"search terms without letters or digits: {terms}")
    return words


def product(cves: DataFrame, name: str, limit: int | None = DEFAULT_LIMIT, **filters) -> DataFrame:
    """Advisories whose description contains a product name, best score first."""
    found = advisory_filters(cves, **filters).filter(contains("description", name))
    return top_scored(found.select(*ADVISORY_RESULT), limit)


def writeups(table: DataFrame, keyword: str, limit: int | None = DEFAULT_LIMIT) -> DataFrame:
    found = table.filter(any_of(contains(name, keyword) for name in ("title", "path", "repo")))
    return first_rows(found.select("path", "title", "repo", "size"), limit, "path")


def exploits(table: DataFrame, keyword: str = "", platform: str = "", limit: int | None = DEFAULT_LIMIT) -> DataFrame:
    if keyword:
        table = table.filter(contains("description", keyword))
    if platform:
        table = table.filter(contains("platform", platform))
    return first_rows(table.select("id", "description", "type", "platform", "cves", "markdown", "url"), limit, "id")


def register_views(tables: dict[str, DataFrame]) -> None:
    """Make the tables available to ``spark.sql`` under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def sql(spark: SparkSession, tables: dict[str, DataFrame], statement: str) -> DataFrame:
    """Any SQL over the tables."""
    register_views(tables)
    return spark.sql(statement)
