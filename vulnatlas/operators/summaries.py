"""Summaries as partial states that add up: what is delivered is counted once, and totals are merged from the parts.

A part has a row per published year, severity and CWE with the number of advisories, a sketch of their sources and a
sketch of their scores. Counts merge by sum, sketches by union, so the total of all deliveries never reads an advisory
again, and a merge of parts is a part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vulnatlas.functions.columns import published_year
from vulnatlas.operators.limits import first_rows

GROUP = ("year", "severity", "cwe")
#: Size of the sketch of distinct sources, as a power of two: about 1.6 % of error.
DISTINCT_LG = 12


def partial_summary(rows: DataFrame, score: str = "cvss") -> DataFrame:
    """``year, severity, cwe, n, sources, scores`` of the rows; columns that they lack are null."""
    def given(name: str, kind: str = "string") -> Column:
        return F.col(name).cast(kind) if name in rows.columns else F.lit(None).cast(kind)

    year = published_year(given("published"))
    slim = rows.select(year.alias("year"), given("severity").alias("severity"), given("cwe").alias("cwe"), given("source").alias("source"), given(score, "double").alias("score"))
    return slim.groupBy(*GROUP).agg(
        F.count("*").alias("n"), F.hll_sketch_agg("source", F.lit(DISTINCT_LG)).alias("sources"), F.kll_sketch_agg_double("score").alias("scores"))


def merged_summary(parts: DataFrame) -> DataFrame:
    """Parts with one row per group again."""
    return parts.groupBy(*GROUP).agg(F.sum("n").alias("n"), F.hll_union_agg("sources").alias("sources"), F.kll_merge_agg_double("scores").alias("scores"))


def kept_severity_counts(parts: DataFrame) -> DataFrame:
    return parts.groupBy("severity").agg(F.sum("n").alias("n"))


def kept_top_cwe(parts: DataFrame, limit: int = 10) -> DataFrame:
    counts = parts.filter(F.col("cwe").isNotNull()).groupBy("cwe").agg(F.sum("n").alias("n"))
    return first_rows(counts, limit, F.desc("n"), "cwe")


def kept_year_counts(parts: DataFrame) -> DataFrame:
    """Advisories per year with the running total; a row per year is few enough for one window."""
    counts = parts.groupBy("year").agg(F.sum("n").alias("n"))
    return counts.withColumn("cumulative", F.sum("n").over(Window.orderBy("year")))


def kept_estimates(parts: DataFrame, quantiles: tuple[float, ...] = (0.5, 0.9)) -> DataFrame:
    """One row: about how many distinct sources there are, and about what score is at each share of the scored rows."""
    whole = parts.agg(F.hll_sketch_estimate(F.hll_union_agg("sources")).alias("sources"), F.kll_merge_agg_double("scores").alias("scores"))
    scored = F.kll_sketch_get_n_double("scores") > 0
    return whole.select("sources", *(
        F.when(scored, F.kll_sketch_get_quantile_double("scores", F.lit(q))).alias(f"score_{round(100 * q)}") for q in quantiles))
