"""Enrichment tables: text view, decoded patches and search over tables of any shape."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vulnatlas.operators.filters import any_of, contains
from vulnatlas.operators.limits import first_rows

# Columns a keyword is looked for in, where a table has them.
SEARCHED_COLUMNS = ("id", "title", "description", "commit_message")


def as_text(column: str, data_type: T.DataType) -> Column:
    """Nested values as JSON text, everything else cast to string."""
    if isinstance(data_type, (T.ArrayType, T.StructType, T.MapType, T.VariantType)):
        return F.to_json(F.col(column), {"ignoreNullFields": "false"})
    return F.col(column).cast("string")


def text_view(df: DataFrame) -> DataFrame:
    """All columns as text, sorted by name."""
    fields = sorted(df.schema.fields, key=lambda field: field.name)
    return df.select(*(as_text(f"`{f.name}`", f.dataType).alias(f.name) for f in fields))


def with_text_arrays(df: DataFrame) -> DataFrame:
    """Arrays as JSON text, other columns and the column order as they are."""
    return df.select(
        *(as_text(f.name, f.dataType).alias(f.name) if isinstance(f.dataType, T.ArrayType) else f.name
          for f in df.schema.fields)
    )


def searched_columns(df: DataFrame) -> list[str]:
    """The known text columns a table has, or all of its columns if it has none of them."""
    return [name for name in df.columns if name in SEARCHED_COLUMNS] or df.columns


def keyword_matches(df: DataFrame, keyword: str, limit: int | None = None) -> DataFrame:
    """Rows of one table with the keyword in a searched column, as text, in the order of these columns."""
    names = searched_columns(df)
    text = df.select(*(as_text(f"`{name}`", df.schema[name].dataType).alias(name) for name in names))
    matches = text.filter(any_of(contains(f"`{name}`", keyword) for name in names))
    return first_rows(matches, limit, *(f"`{name}`" for name in names))


def search_tables(tables: dict[str, DataFrame], keyword: str, limit: int | None = None) -> DataFrame:
    """Matches in all tables, ``limit`` per table, with the name of the table in column ``table``.

    Every table is limited on its own before the union: each task keeps its best rows only, so
    no table passes through a single task.
    """
    found = [
        keyword_matches(df, keyword, limit).select(F.lit(name).alias("table"), "*")
        for name, df in sorted(tables.items())
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found)


def match_counts(matches: DataFrame) -> DataFrame:
    return matches.groupBy("table").agg(F.count("*").alias("n"))


def with_parsed_json(df: DataFrame, *columns: str) -> DataFrame:
    """Each text column parsed into ``<name>_json`` where it is JSON, null where it is not."""
    return df.select("*", *(F.try_parse_json(name).alias(f"{name}_json") for name in columns))


def decoded_patches(patches: DataFrame, encoded: str = "patch_text_b64") -> DataFrame:
    """One row per patch with its diff as text, null where it is not base64 or not UTF-8.

    ``patches`` has ``id``, ``title``, ``cwe`` and an array of structs ``patches``, or that array as JSON
    text; text that is not such an array gives no row.
    """
    if isinstance(patches.schema["patches"].dataType, T.StringType):
        schema = f"array<struct<url: string, {encoded}: string>>"
        patches = patches.withColumn("patches", F.from_json("patches", schema))
    one = patches.select("id", "title", "cwe", F.posexplode("patches").alias("n", "patch"))
    diff = F.try_validate_utf8(F.try_to_binary(F.col(f"patch.{encoded}"), F.lit("base64")).cast("string"))
    return one.select("id", "title", "cwe", "n", F.col("patch.url").alias("url"), diff.alias("diff"))


def patch_search(patches: DataFrame, keyword: str, limit: int | None = None) -> DataFrame:
    """Patches with the keyword in id, title, CWE or the stored (encoded) patch text."""
    text = with_text_arrays(patches.select("id", "title", "patches", "cwe"))
    matches = text.filter(any_of(contains(name, keyword) for name in text.columns))
    return first_rows(matches, limit, *text.columns)


def decoded_patch_search(patches: DataFrame, keyword: str, limit: int | None = None) -> DataFrame:
    """Patches whose diff itself contains the keyword."""
    return first_rows(decoded_patches(patches).filter(contains("diff", keyword)), limit, "id", "n")
