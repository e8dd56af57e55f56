"""Substring search by character n-grams: candidates from the grams, each confirmed on its text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vulnatlas.operators.filters import contains

N = 3
#: Of a query's grams, so many of the rarest are looked up; the texts decide.
ASKED = 4
#: Candidates up to which their keys are given to the scan, which then reads only row groups that may hold them.
KEYS_IN_SCAN = 1000


def grams(text: Column) -> Column:
    """The distinct runs of ``N`` characters of the lower-cased text, in its own row; none for null or shorter texts."""
    every = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(f"(?s)(?=({'.' * N}))"), F.lit(1))
    return F.array_distinct(every)


def gram_postings(df: DataFrame, key: str, column: str, *keep: str) -> DataFrame:
    """``gram, id``: which row's ``column`` holds which gram."""
    return df.select(F.col(key).alias("id"), *keep, F.explode(grams(F.col(column))).alias("gram"))


def query_grams(spark: SparkSession, text: str) -> list[str]:
    """The grams of a literal, through the function that indexed the texts; the optimizer evaluates it."""
    return list(spark.sql("SELECT :t AS t", {"t": text}).select(grams(F.col("t")).alias("g")).first().g)


def substring_rows(rows: DataFrame, index: DataFrame, frequencies: DataFrame, column: str, text: str, key: str = "id") -> DataFrame:
    """Rows whose ``column`` contains ``text`` in any case, as :func:`contains` says.

    ``index`` has (gram, id), ``frequencies`` (gram, n). A text shorter than a gram is looked for in all rows.
    """
    wanted = query_grams(rows.sparkSession, text)
    if not wanted:
        return rows.filter(contains(column, text))
    known = sorted((r.n, r.gram) for r in frequencies.filter(F.col("gram").isin(wanted)).groupBy("gram").agg(F.sum("n").alias("n")).collect())
    if len(known) < len(wanted):
        return rows.filter(F.lit(False))
    rarest = [gram for _, gram in known[:ASKED]]
    found = index.filter(F.col("gram").isin(rarest)).groupBy("id").agg(F.count_distinct("gram").alias("n")).filter(F.col("n") == len(rarest))
    found = found.select(F.col("id").alias(key))
    if known[0][0] <= KEYS_IN_SCAN:
        rows = rows.filter(F.col(key).isin([row[0] for row in found.collect()]))
    else:
        rows = rows.join(found, key, "left_semi")
    return rows.filter(contains(column, text))
