"""Incremental ingest of newly landed files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vulnatlas.operators.merging import one_per_key
from vulnatlas.operators.normalize import normalize_advisories
from vulnatlas.operators.segments import append_segment
from vulnatlas.sinks.writers import append_new
from vulnatlas.sources.advisories import feed_items, parse_items
from vulnatlas.sources.feed_cuts import feed_text


def ingest_landed(
    stream: DataFrame, target: str, checkpoint: str, key: str = "id", order: tuple[str | Column, ...] = (),
    partition_by: str | None = None, transient: tuple[str, ...] = (),
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> None:
    """Append the unseen rows of everything that landed since the last call, then stop.

    The checkpoint remembers the files already read; the anti-join against the target makes a
    batch that is run again after a failure append nothing twice.
    """

    def append(batch: DataFrame, _: int) -> None:
        append_new(transform(batch), target, key, *order, partition_by=partition_by, transient=transient)

    query = (
        stream.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def ingest_indexed(
    stream: DataFrame, root: str, checkpoint: str, order: tuple[str | Column, ...] = (),
    transform: Callable[[DataFrame], DataFrame] = lambda df: df, **made,
) -> None:
    """Append everything that landed since the last call to the search index at ``root``, a segment per batch, then stop.

    The index's state remembers the last batch of each checkpoint, so one that was stored but not noted by the
    stream is passed over when it comes again. ``made`` is how :func:`append_segment` makes the index.
    """

    def append(batch: DataFrame, number: int) -> None:
        append_segment(batch.sparkSession, transform(batch), root, *order, batch=(checkpoint, number), **made)

    query = stream.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def ingest_latest(stream: DataFrame, target: str, checkpoint: str, key: str = "id", modified: str = "last_modified") -> None:
    """Keep the most recently modified row of each key over all that ever landed, then stop; :func:`latest_state` reads it.

    The stream's state holds the winning row of each key, so a delivery that comes late, or again, changes nothing
    unless it is newer. Of rows modified at the same time, or never, one wins by the hash of all its columns, in
    whatever order they land. Rows without a key are left out. A batch writes the rows that changed to a folder
    of its own number; one that runs again after a failure writes the same folder anew.
    """
    newest = F.max_by(F.struct(*stream.columns), F.struct(F.col(modified), F.xxhash64(*stream.columns)))
    latest = stream.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("of_key")).agg(newest.alias("row")).select("row.*")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target.rstrip('/')}/batch={number}")

    query = (
        latest.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def latest_state(spark: SparkSession, target: str, key: str = "id") -> DataFrame:
    """The row of each key that :func:`ingest_latest` wrote last."""
    return one_per_key(spark.read.parquet(target), key, F.desc("batch")).drop("batch")


def landed_feeds(spark: SparkSession, landing: str, max_files: int | None = None) -> DataFrame:
    """Text of the feed documents that land in a folder; at most ``max_files`` documents a batch."""
    limit = {"maxFilesPerTrigger": max_files} if max_files else {}
    return feed_text(spark.readStream.options(**limit), landing)


def _normalized(batch: DataFrame) -> DataFrame:
    return normalize_advisories(parse_items(feed_items(batch)), "source_order")


def ingest_feeds(spark: SparkSession, landing: str, target: str, checkpoint: str, max_files: int | None = None) -> None:
    """Ingest feed documents newly landed in a folder into the ``cves`` table at ``target``.

    The first delivery of an id stays: within a batch by the order of
    :func:`~vulnatlas.sources.advisories.feed_items`, and batches of ``max_files`` take files in the order they
    landed too. Without ``max_files`` all of them are one batch.
    """
    ingest_landed(
        landed_feeds(spark, landing, max_files), target, checkpoint, order=("source_order",), partition_by="year",
        transient=("source_order",), transform=_normalized,
    )


def ingest_indexed_feeds(
    spark: SparkSession, landing: str, root: str, checkpoint: str, max_files: int | None = None, **made,
) -> None:
    """Ingest feed documents as :func:`ingest_feeds` does, into the search index at ``root``."""
    ingest_indexed(
        landed_feeds(spark, landing, max_files), root, checkpoint, order=("source_order",), transform=_normalized,
        transient=("source_order",), **made,
    )
