"""Idempotent ingest: deduplication, append of new rows, upsert and key checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def one_per_key(df: DataFrame, key: str, *order: str | Column) -> DataFrame:
    """The first row of each key in the given order, or else in that of all columns.

    ``row_number() = 1`` is limited per key before the shuffle too, so a key with very many
    copies sends at most one row per task.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(key).orderBy(*(order or df.columns))))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def new_rows(incoming: DataFrame, existing: DataFrame, key: str, *order: str | Column) -> DataFrame:
    """First incoming row of each key that is not stored yet.

    Copies are dropped before the join: it then meets each key once, and finds the incoming rows
    partitioned by key already.
    """
    return one_per_key(incoming, key, *order).join(existing.select(key), key, "left_anti")


def latest_rows(existing: DataFrame, incoming: DataFrame, key: str, modified: str) -> DataFrame:
    """Both row sets merged, the most recently modified row of each key kept; stored rows win ties."""
    both = existing.withColumn("_stored", F.lit(0)).unionByName(
        incoming.withColumn("_stored", F.lit(1)), allowMissingColumns=True
    )
    return one_per_key(both, key, F.desc_nulls_last(modified), "_stored").drop("_stored")


def upsert(old: DataFrame, new: DataFrame, key: str, *order: str | Column) -> DataFrame:
    """The first entry of each key in ``new``, and the entries of ``old`` whose key is not in ``new``."""
    one = one_per_key(new, key, *order)
    return old.join(one.select(key), key, "left_anti").unionByName(one)


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")


def require_unique(df: DataFrame, key: str) -> DataFrame:
    """``df`` itself, after a check that fails with the first duplicated keys."""
    duplicates = duplicate_keys(df, key).limit(5).collect()
    if duplicates:
        raise ValueError(f"duplicate {key}: " + ", ".join(f"{row[key]} ({row.n} rows)" for row in duplicates))
    return df
