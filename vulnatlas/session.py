"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# AQE splits skewed join partitions and coalesces small ones at run time; UTC keeps
# timestamps comparable between engines; zstd is the format tables are published in.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "vulnatlas", master: str | None = None, **conf: str) -> SparkSession:
    """Start or reuse a session with :data:`SETTINGS`; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path under the folder the cluster names in ``spark.checkpoint.dir``.

    Written intermediate tables go there so that any executor can read them again after
    another is lost. Only a local session may fall back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="vulnatlas-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def hadoop_path(spark: SparkSession, path: str):
    """The path and its file system, whatever storage the cluster uses."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


@contextmanager
def staged(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``df`` written to the shared folder for as long as the block runs.

    For rows that are costly to compute and read more than once, such as by a range shuffle, which
    samples its input first. A lost executor then costs a read, not the computation.
    """
    spark, path = df.sparkSession, shared_path(df.sparkSession, name)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        target, fs = hadoop_path(spark, path)
        fs.delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    target, fs = hadoop_path(spark, path)
    return fs.exists(target)


def write_text_file(spark: SparkSession, path: str, text: str) -> None:
    """One small text file, such as a dataset's sidecar."""
    target, fs = hadoop_path(spark, path)
    out = fs.create(target, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
