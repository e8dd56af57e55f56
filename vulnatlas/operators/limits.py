"""Ordered limits. Every order ends in a unique key, so the kept rows never depend on the plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vulnatlas.session import shared_path

#: Rows that one task may hold to sort out the first ones; more are cut by ranges.
ONE_TASK = 10_000


def first_rows(df: DataFrame, limit: int | None, *order) -> DataFrame:
    """The first ``limit`` rows in the given order; ``None`` keeps all rows, unsorted.

    Up to ``ONE_TASK`` rows come sorted from one task. A larger cut stays distributed, see :func:`cut_by_ranges`;
    its rows come in ranges of the order.
    """
    if limit is None:
        return df
    if limit < 0:
        raise ValueError(f"limit must be at least 0, not {limit}")
    return df.orderBy(*order).limit(limit) if limit <= ONE_TASK else cut_by_ranges(df, limit, *order)


def cut_by_ranges(df: DataFrame, limit: int, *order) -> DataFrame:
    """The first ``limit`` rows, of which no task holds more than one range.

    Rows are written in ranges of the order, each counted; whole ranges are taken up to the one that the limit falls
    into, and of that one its first rows.
    """
    spark, path = df.sparkSession, shared_path(df.sparkSession, "ranges")
    part = "_".join(["range", *df.columns])  # longer than any column's name, so none of them
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.withColumn(part, F.spark_partition_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    left, whole = limit, []
    for number, n in rows.groupBy(part).count().orderBy(part).collect():
        if n > left:
            rest = rows.filter(F.col(part) == number).orderBy(*order).limit(left)
            return rows.filter(F.col(part).isin(whole)).unionAll(rest).drop(part)
        whole.append(number)
        left -= n
    return rows.drop(part)


def top_scored(df: DataFrame, limit: int | None, score: str = "cvss", key: str = "id") -> DataFrame:
    return first_rows(df, limit, F.desc_nulls_last(score), F.asc(key))
