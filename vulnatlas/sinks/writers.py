"""Published Parquet, JSON lines, catalog tables and provenance."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.observation import Observation

from vulnatlas.functions.columns import json_row, published_year
from vulnatlas.operators.merging import new_rows, one_per_key, require_unique, upsert
from vulnatlas.session import path_exists, staged, write_text_file
from vulnatlas.sinks.manifest import publish_state, read_state
from vulnatlas.sources.tables import ENRICHMENT_PREFIX, qualified, stored_table

# Published folder of each table.
PUBLISHED = {
    "cves": "cves",
    "exploits": "exploits",
    "writeups": "writeups",
    "hf_vuln_scores": "scores",
    "hf_vuln_patches": "patches",
}


def counted_write(df: DataFrame, write) -> int:
    """Run ``write`` on ``df`` and return the rows it wrote, counted during that same job."""
    counter = Observation()
    write(df.observe(counter, F.count(F.lit(1)).alias("n")))
    return counter.get["n"]


def publish_table(df: DataFrame, path: str, key: str | None, parts: int | None = None) -> int:
    """Write one table as Parquet ordered by ``key`` and return its row count.

    Ranges of the key per file, sorted rows and a bloom filter make a lookup by key read one row
    group. ``parts`` fixes the number of files. Without a key, rows are dealt out evenly: no other column is
    known to part them.
    """
    if key is None:
        dealt = df.repartition(parts) if parts else df
        return counted_write(dealt, lambda d: d.write.mode("overwrite").option("compression", "zstd").parquet(path))
    ranged = df.repartitionByRange(parts, key) if parts else df.repartitionByRange(key)
    ordered = ranged.sortWithinPartitions(key)
    return counted_write(
        ordered,
        lambda d: d.write.mode("overwrite")
        .option("compression", "zstd")
        .option(f"parquet.bloom.filter.enabled#{key}", "true")
        .parquet(path),
    )


def publish(tables: dict[str, DataFrame], directory: str, parts: dict[str, int] | None = None) -> dict[str, int]:
    """Publish those of the known tables that are given; row counts by published name."""
    counts = {}
    for table, folder in PUBLISHED.items():
        if table in tables:
            df = tables[table]
            key = next((name for name in ("path", "id") if name in df.columns), None)
            path = f"{directory.rstrip('/')}/{folder}/train"
            counts[folder] = publish_table(df, path, key, (parts or {}).get(folder))
    return counts


def publish_together(spark: SparkSession, root: str, tables: dict[str, DataFrame], keys: dict[str, str] | None = None) -> dict[str, int]:
    """Publish the given tables as one new state of ``root``, in which all others stay as they are; their row counts.

    Every table is written to a folder of its own before the state that names them all is published, so readers
    (:func:`vulnatlas.sources.tables.read_together`) see the old tables or the new ones, never some of each. Tables
    with a key in ``keys`` are stored in ranges of it.
    """
    root = root.rstrip("/")
    number, state = read_state(spark, root)
    folders, counts = dict(state.get("tables", {})), {}
    for name, df in tables.items():
        folders[name] = f"{name}/{uuid.uuid4().hex}"
        path, key = f"{root}/{folders[name]}", (keys or {}).get(name)
        counts[name] = publish_table(df, path, key) if key else counted_write(df, lambda d, path=path: d.write.parquet(path))
    publish_state(spark, root, number, state | {"tables": folders})
    return counts


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object per row, nulls written, non-ASCII text as it is."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def result_lines(df: DataFrame) -> DataFrame:
    """Result rows as JSON objects in column ``line``."""
    return df.select(json_row(df.columns).alias("line"))


def replace_table(df: DataFrame, table: str, key: str | None = None) -> DataFrame:
    """Replace one catalog table; all others stay.

    A ``key`` has to be unique; the rows are then stored in its order, with a bloom filter for lookups.
    The new rows are written beside the old table, which goes only when they are whole (:func:`swap_in`).
    """
    if key is None:
        return swap_in(df, table)
    with staged(df, table) as rows:
        ordered = require_unique(rows, key).repartitionByRange(key).sortWithinPartitions(key)
        return swap_in(ordered, table, {f"parquet.bloom.filter.enabled#{key}": "true"})


def upsert_table(new: DataFrame, table: str, key: str) -> DataFrame:
    """Entries of ``new`` replace those of their key in a catalog table; all others are kept.

    A key that repeats in ``new`` is stored once, by its first row in the order of all columns.
    """
    spark = new.sparkSession
    finish_swap(spark, table)
    there = spark.catalog.tableExists(qualified(spark, table))
    return swap_in(upsert(stored_table(spark, table), new, key) if there else one_per_key(new, key), table)


#: How the names of a swap's own tables begin, and the property that says which table they belong to.
SWAP_NEW, SWAP_OLD, SWAP_OF = "vulnatlas_swap_new__", "vulnatlas_swap_old__", "vulnatlas.swap_of"


def swap_in(df: DataFrame, table: str, options: dict[str, str] | None = None) -> DataFrame:
    """Store ``df`` as a catalog table; an old one of that name stays readable until the new rows are whole.

    Old aside, new in its place, old dropped. A call that was stopped in between is finished by the next one. The
    tables on the way have names that no stored table may have and say whose they are; nothing else is dropped.
    """
    spark = df.sparkSession
    if table.lower().startswith((SWAP_NEW, SWAP_OLD)):
        raise ValueError(f"names of tables must not begin like {table}")
    finish_swap(spark, table)
    now, fresh, aside = (qualified(spark, name) for name in (table, f"{SWAP_NEW}{table}", f"{SWAP_OLD}{table}"))
    df.writeTo(fresh).using("parquet").options(**(options or {})).tableProperty(SWAP_OF, table.lower()).create()
    if spark.catalog.tableExists(now):
        spark.sql(f"ALTER TABLE {now} SET TBLPROPERTIES ('{SWAP_OF}' = '{table.lower()}')")
        spark.sql(f"ALTER TABLE {now} RENAME TO {aside}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {now}")
    _drop_own(spark, aside, table)
    return stored_table(spark, table)


def finish_swap(spark: SparkSession, table: str) -> None:
    """Bring a swap that was stopped to its end: the old table moves aside only after the new one is whole."""
    now, fresh, aside = (qualified(spark, name) for name in (table, f"{SWAP_NEW}{table}", f"{SWAP_OLD}{table}"))
    there = spark.catalog.tableExists(now)
    whole, moved = (_is_own(spark, name, table) for name in (fresh, aside))
    if moved and not there:
        spark.sql(f"ALTER TABLE {fresh if whole else aside} RENAME TO {now}")
    for name in (fresh, aside):
        _drop_own(spark, name, table)


def _is_own(spark: SparkSession, name: str, table: str) -> bool:
    """Whether the table is there; one that no swap of ``table`` made is an error."""
    if not spark.catalog.tableExists(name):
        return False
    properties = {row.key: row.value for row in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    if properties.get(SWAP_OF) != table.lower():
        raise ValueError(f"{name} stands where a swap of {table} keeps its tables, but belongs to something else")
    return True


def _drop_own(spark: SparkSession, name: str, table: str) -> None:
    if _is_own(spark, name, table):
        spark.sql(f"DROP TABLE {name}")


def append_new(
    incoming: DataFrame, path: str, key: str, *order,
    partition_by: str | None = None, transient: tuple[str, ...] = (),
) -> int:
    """Append the rows whose key is not stored at ``path`` yet; the number of rows appended.

    Running it again appends nothing. Of an incoming key the first row in ``order`` counts, or else in that
    of all columns. Rows are dealt out by ``partition_by`` first, so that a batch writes few files for each of
    its partitions; a large one is split. The folder is created by the first run; columns named in
    ``transient`` serve the order only and are not stored.
    """
    spark = incoming.sparkSession
    if path_exists(spark, path):
        fresh = new_rows(incoming, spark.read.schema(incoming.schema).parquet(path), key, *order)
    else:
        fresh = one_per_key(incoming, key, *order)

    def write(df: DataFrame) -> None:
        writer = df.write.partitionBy(partition_by) if partition_by else df.write
        writer.mode("append").parquet(path)

    fresh = fresh.drop(*transient)
    return counted_write(fresh.hint("rebalance", partition_by) if partition_by else fresh, write)


def write_documents(items: DataFrame, path: str) -> int:
    """Append unseen feed items to the document store: raw JSON by id and year."""
    documents = items.select(
        F.col("cve.id").alias("id"), published_year(F.col("cve.published")).alias("year"), "raw", "source_order"
    )
    return append_new(documents, path, "id", "source_order", partition_by="year", transient=("source_order",))


def provenance(
    spark: SparkSession, dataset: str, table: str, path: str, rows: int,
    mode: str = "parquet", config: str = "default", split: str = "train",
) -> DataFrame:
    """One row that records where an enrichment table came from."""
    return spark.createDataFrame(
        [(dataset, mode, config, split, rows, path, table)],
        "dataset string, mode string, config string, split string, rows bigint, jsonl string, table string",
    )


def land_enrichment(df: DataFrame, dataset: str, directory: str, table: str = "") -> int:
    """Write an enrichment dataset as JSON lines with the sidecar that names its table."""
    name = dataset.replace("/", "__")  # fixed value: how landed files are named
    path = f"{directory.rstrip('/')}/{name}.jsonl"
    rows = counted_write(df, lambda d: write_json_lines(d, path))
    record = provenance(df.sparkSession, dataset, table or f"{ENRICHMENT_PREFIX}{name}", path, rows)
    (sidecar,) = result_lines(record).collect()
    write_text_file(df.sparkSession, f"{directory.rstrip('/')}/{name}_meta.json", sidecar.line)
    return rows
