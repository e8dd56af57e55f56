"""Exploit catalogue: a CSV file with a header row and quoted multi-line fields."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vulnatlas.operators.limits import first_rows

# The catalogue columns the tables are made from.
CATALOGUE_COLUMNS = (
    "id", "file", "description", "date_published", "author", "type", "platform", "port",
    "verified", "codes", "tags",
)

_CORRUPT = "_short_row"
_CSV = {"header": True, "multiLine": True, "quote": '"', "escape": '"', "encoding": "UTF-8"}


def read_catalogue(spark: SparkSession, path: str | list[str], limit: int | None = None) -> DataFrame:
    """All rows as text, columns found by the header of each file.

    A field left empty is ``''``; one that a short row does not reach is null, and so is a column
    the file does not have. ``source_order`` tells the order of the rows. A catalogue is a few files, whose
    headers the driver reads; files of one header are read together.
    """
    headers: dict[tuple[str, ...], list[str]] = {}
    for file in sorted(spark.read.options(**_CSV).csv(path).inputFiles()):
        headers.setdefault(tuple(spark.read.options(**_CSV).csv(file).columns), []).append(file)
    parts = [_read_same(spark, files, header) for header, files in headers.items()]
    return first_rows(reduce(DataFrame.unionByName, parts), limit, "source_order")


def _read_same(spark: SparkSession, path: list[str], header: tuple[str, ...]) -> DataFrame:
    """Rows of files that share a header."""
    fields = [T.StructField(name, T.StringType()) for name in (*header, _CORRUPT)]
    rows = (
        spark.read.options(**_CSV, columnNameOfCorruptRecord=_CORRUPT).schema(T.StructType(fields)).csv(path)
    )

    def field(name: str):
        if name not in header:
            return F.lit(None).cast("string").alias(name)
        whole = F.col(_CORRUPT).isNull()
        return F.when(whole, F.coalesce(F.col(name), F.lit(""))).otherwise(F.col(name)).alias(name)

    # A file with multi-line fields is read by one task, so the ids follow its rows.
    place = F.struct(F.col("_metadata.file_path"), F.monotonically_increasing_id().alias("n"))
    return rows.select(*map(field, CATALOGUE_COLUMNS), place.alias("source_order"))
