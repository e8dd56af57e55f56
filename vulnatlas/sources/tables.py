"""Parquet folders, enrichment datasets and catalog tables."""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vulnatlas.session import path_exists
from vulnatlas.sinks.manifest import read_state
from vulnatlas.sources.jsonl import read_any

ENRICHMENT_PREFIX = "hf_"


def read_shards(spark: SparkSession, path: str | list[str], limit: int | None = None) -> DataFrame:
    """All Parquet shards below ``path`` as one dataset, columns of all shards merged."""
    paths = [path] if isinstance(path, str) else path
    rows = spark.read.option("mergeSchema", True).option("recursiveFileLookup", True).parquet(*paths)
    return rows if limit is None else rows.limit(limit)


def spread(scan: DataFrame) -> DataFrame:
    """A scan of few splits spread over all cores, for work that costs far more than a shuffle.

    A scan with a split per core or more is left alone, so no core ever sends more than one split.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


def read_published(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """A published table: every part of ``<directory>/<name>/train``."""
    return spark.read.parquet(f"{directory.rstrip('/')}/{name}/train")


def read_together(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All tables of the newest published state; those of an older one keep their files until they are removed."""
    _, state = read_state(spark, root)
    return {name: spark.read.parquet(f"{root.rstrip('/')}/{folder}") for name, folder in sorted(state.get("tables", {}).items())}


def existing_tables(spark: SparkSession, names: list[str]) -> dict[str, DataFrame]:
    """The named catalog tables that exist; the others are left out."""
    return {name: stored_table(spark, name) for name in names if spark.catalog.tableExists(qualified(spark, name))}


def qualified(spark: SparkSession, table: str) -> str:
    """The stored table with its database, so that a temporary view of the same name is not meant."""
    return f"{spark.catalog.currentDatabase()}.{table}"


def stored_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(qualified(spark, table))


def enrichment_tables(spark: SparkSession) -> list[str]:
    """Names of the registered enrichment tables."""
    return sorted(t.name for t in spark.catalog.listTables() if t.name.startswith(ENRICHMENT_PREFIX))


def identifiers(names: list[str], what: str) -> list[str]:
    """The names as SQL identifiers that need no quotes: each sign that is no word character becomes ``_``.

    Names are kept at full length. Two that would become the same, in any case, are an error, as one
    would replace the other.
    """
    made = [re.sub(r"\W", "_", name) for name in names]
    if len({name.lower() for name in made}) < len(made):
        raise ValueError(f"{what} names clash once made safe: {names}")
    return made


def with_safe_columns(df: DataFrame) -> DataFrame:
    """Columns renamed by :func:`identifiers`."""
    return df.toDF(*identifiers(df.columns, "column"))


def read_provenance(spark: SparkSession, directory: str) -> DataFrame:
    """The records of all sidecars in a folder."""
    schema = "dataset string, mode string, config string, split string, rows bigint, jsonl string, `table` string"
    return spark.read.schema(schema).option("multiLine", True).option("pathGlobFilter", "*_meta.json").json(directory)


def discover_enrichment(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    """One DataFrame per ``<name>_meta.json`` sidecar that names a table and has its ``<name>.jsonl``.

    Sidecars are a handful of small files written by the landing step, so the driver reads them;
    the datasets they name are read by Spark. Two sidecars of one table are an error.
    """
    directory = directory.rstrip("/")
    sidecars = (
        spark.read.option("pathGlobFilter", "*_meta.json").text(directory, wholetext=True)
        .select(F.col("_metadata.file_name").alias("name"), "value").orderBy("name").collect()
    )
    found = []
    for sidecar in sidecars:
        data = sidecar.name.removesuffix("_meta.json") + ".jsonl"
        table = json.loads(sidecar.value).get("table")
        if table and path_exists(spark, f"{directory}/{data}"):
            found.append((table, f"{directory}/{data}"))
    names = identifiers([table for table, _ in found], "table")
    return {name: with_safe_columns(read_any(spark, path)) for name, (_, path) in zip(names, found, strict=True)}
