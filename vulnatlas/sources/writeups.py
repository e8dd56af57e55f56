"""Writeup files as rows of ``(path, content, size)``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vulnatlas.session import hadoop_path

# Extensions of text files, and the manifest that is not a writeup.
TEXT_EXTENSIONS = (
    ".md", ".txt", ".json", ".py", ".rb", ".sh", ".php", ".yaml", ".yml", ".xml", ".html", ".js",
    ".go", ".rs", ".c", ".java", ".sql",
)
MANIFEST = "_repos.json"


def _glob() -> str:
    """File name glob of the extensions in any case; other files are not even opened."""
    return "*.{" + ",".join("".join(f"[{c}{c.upper()}]" for c in ext[1:]) for ext in TEXT_EXTENSIONS) + "}"


def skipped_writeups(spark: SparkSession, root: str) -> DataFrame:
    """``path, reason`` of the files below ``root`` that :func:`read_writeups` gives no whole text for.

    ``extension``: not one of the text files; ``not UTF-8``: read, with signs replaced. The content of text files alone is
    opened. What Spark does not list at all, :func:`unlisted_writeups` tells from the file system's own listing.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("ignoreMissingFiles", True)
        .option("ignoreCorruptFiles", True).load(root)
    )
    listed = files.select(_relative(spark, root).alias("path"))
    name = F.lower(F.element_at(F.split("path", "/"), -1))
    text = reduce(Column.__or__, (F.endswith(name, F.lit(ext)) for ext in TEXT_EXTENSIONS))
    unread = listed.filter(~text).select("path", F.lit("extension").alias("reason"))
    opened = files_of_text(spark, root).filter(~F.is_valid_utf8(F.col("content").cast("string")))
    return unread.unionAll(opened.select(_relative(spark, root).alias("path"), F.lit("not UTF-8").alias("reason")))


def unlisted_writeups(spark: SparkSession, root: str) -> list[tuple[str, str]]:
    """Path and reason of files that Spark does not list: ``hidden``, by a name that begins with ``_`` or ``.``, theirs or a folder's; ``empty``.

    The file system lists them one after the other on the driver; these paths alone are kept.
    """
    base, fs = hadoop_path(spark, root)
    start = len(fs.makeQualified(base).toString().rstrip("/")) + 1
    found, files = [], fs.listFiles(base, True)
    while files.hasNext():
        file = files.next()
        path = file.getPath().toString()[start:]
        if any(part.startswith(("_", ".")) for part in path.split("/")):
            found.append((path, "hidden"))
        elif not file.getLen():
            found.append((path, "empty"))
    return sorted(found)


def read_writeups(spark: SparkSession, root: str) -> DataFrame:
    """All text files below ``root``; ``path`` is relative to it.

    The file source does not list names that start with ``_`` or ``.`` and does not open empty
    files. Where those are wanted, land them as rows ``(path, content, size)`` instead. What is left out
    is told by :func:`skipped_writeups` and :func:`unlisted_writeups`.
    """
    text = F.make_valid_utf8(F.col("content").cast("string"))
    return files_of_text(spark, root).select(_relative(spark, root).alias("path"), text.alias("content"), F.col("length").alias("size"))


def files_of_text(spark: SparkSession, root: str) -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", _glob())
        .option("ignoreMissingFiles", True)
        .option("ignoreCorruptFiles", True)
        .load(root)
    )


def _relative(spark: SparkSession, root: str) -> Column:
    base, fs = hadoop_path(spark, root)
    return F.substr("path", F.lit(len(fs.makeQualified(base).toString().rstrip("/")) + 2))
