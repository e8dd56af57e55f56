"""Line-delimited JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fields of the advisory and exploit indices.
ADVISORY_INDEX = """
    id string, published string, lastModified string, severity string, cvssScore double,
    cvssVector string, cwe string, description string, references array<string>,
    refTags array<string>, source string, status string
"""
EXPLOIT_INDEX = """
    id bigint, description string, date string, author string, type string, platform string,
    port string, verified string, cves array<string>, tags array<string>, markdown string,
    source string, exploitdb_url string
"""


def read_index(spark: SparkSession, path: str | list[str], schema: str, key: str = "id") -> DataFrame:
    """Typed rows of an index. A line that is not JSON is skipped; one without a key is an error."""
    lines = spark.read.text(path).filter(F.try_parse_json("value").isNotNull())
    rows = lines.select(F.from_json("value", schema).alias("row")).select("row.*")
    problem = F.raise_error(F.lit(f"index line without {key}")).cast("boolean")
    return rows.filter(F.when(F.col(key).isNotNull(), True).otherwise(problem))


def read_any(spark: SparkSession, path: str | list[str], schema: str | None = None) -> DataFrame:
    """Rows of any shape: the union of all keys, sorted by name.

    Without ``schema`` every line is read once more to infer it; no sample decides on a column.
    """
    reader = spark.read.option("mode", "FAILFAST")
    rows = reader.schema(schema).json(path) if schema else reader.json(path)
    return rows.select(*(F.col(f"`{name}`") for name in sorted(rows.columns)))
