"""Summaries of the tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vulnatlas.functions.columns import published_year
from vulnatlas.operators.limits import first_rows, top_scored


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table"), "n") for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def severity_counts(cves: DataFrame) -> DataFrame:
    return cves.groupBy("severity").agg(F.count("*").alias("n"))


def top_cwe(cves: DataFrame, limit: int = 10) -> DataFrame:
    counts = cves.filter(F.col("cwe").isNotNull()).groupBy("cwe").agg(F.count("*").alias("n"))
    return first_rows(counts, limit, F.desc("n"), "cwe")


def top_scored_prefixes(cves: DataFrame, limit: int = 5, width: int = 60) -> DataFrame:
    """First characters of the descriptions of the highest scored advisories."""
    # Ids are ranked first, so that no description is read but those of the best.
    ids = top_scored(cves.select("id", "cvss"), limit).select("id").distinct()
    best = top_scored(cves.select("id", "cvss", "description").join(ids, "id"), limit)
    return best.select("id", "cvss", F.substring("description", 1, width).alias("description"))


def year_counts(cves: DataFrame) -> DataFrame:
    """Advisories per published year with the running total over the years."""
    counts = cves.groupBy(published_year(F.col("published")).alias("year")).agg(F.count("*").alias("n"))
    # One row per year is left here, so a window over all of them stays small.
    return counts.withColumn("cumulative", F.sum("n").over(Window.orderBy("year")))


def stats(cves: DataFrame, exploits: DataFrame, writeups: DataFrame, enrichment: list[str]) -> DataFrame:
    """All summaries as rows ``(section, item, n)``."""

    def section(name: str, df: DataFrame, item, n) -> DataFrame:
        return df.select(F.lit(name).alias("section"), item.alias("item"), n.alias("n"))

    none = F.lit(None).cast("bigint")
    counts = table_counts({"cves": cves, "exploits": exploits, "writeups": writeups})
    parts = [
        section("rows", counts, F.col("table"), F.col("n")),
        section("by_severity", severity_counts(cves), F.col("severity"), F.col("n")),
        section("top_cwe", top_cwe(cves), F.col("cwe"), F.col("n")),
        section("top_scored", top_scored_prefixes(cves), F.col("description"), none),
    ]
    if enrichment:
        names = cves.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, enrichment))).alias("name"))
        parts.append(section("enrichment_tables", names, F.col("name"), none))
    return reduce(DataFrame.unionAll, parts)
