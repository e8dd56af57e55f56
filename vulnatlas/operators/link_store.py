"""Stored links between advisories and exploits, laid out so that joins and lookups move nothing.

Advisories and links are catalog tables of the same number of buckets by CVE id, sorted in them. A join of the two
reads each bucket once on both sides without a shuffle; a lookup reads one bucket. Links carry the exploit's columns
that answers hold, so the exploits themselves are not read. New exploits are added bucket by bucket: their links are
dealt out to the buckets, compared with the links there, and written as one more file for each bucket touched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vulnatlas.operators.links import link_exploits
from vulnatlas.sources.tables import qualified, stored_table

BUCKETS = 64
LINK_COLUMNS = ("description", "type", "platform", "markdown", "url")


def _save(df: DataFrame, table: str, key: str, buckets: int, mode: str) -> None:
    dealt = df.repartition(buckets, key).sortWithinPartitions(key)
    dealt.write.mode(mode).format("parquet").bucketBy(buckets, key).sortBy(key).saveAsTable(qualified(df.sparkSession, table))


def store_links(cves: DataFrame, exploits: DataFrame, cves_table: str, links_table: str, buckets: int = BUCKETS) -> None:
    """Store both tables anew: ``cves`` by id, and a link per exploit and distinct CVE id that it names.

    Links of CVE ids that are not among ``cves`` are stored too, for advisories that come later. Advisories without
    an id are left out: nothing can link to them.
    """
    links = link_exploits(exploits, *LINK_COLUMNS)
    _save(cves.filter("id IS NOT NULL"), cves_table, "id", buckets, "overwrite")
    _save(links, links_table, "cve_id", buckets, "overwrite")


def _buckets_of(spark: SparkSession, table: str) -> int:
    rows = spark.sql(f"DESCRIBE EXTENDED {qualified(spark, table)}").filter("col_name = 'Num Buckets'").collect()
    return int(rows[0].data_type)


def add_links(exploits: DataFrame, links_table: str) -> int:
    """Add the links of ``exploits`` that are not stored yet; how many there were. Run again, it adds nothing."""
    spark = exploits.sparkSession
    buckets = _buckets_of(spark, links_table)
    new = link_exploits(exploits, *LINK_COLUMNS).dropDuplicates(["cve_id", "exploit_id"]).repartition(buckets, "cve_id")
    known = stored_table(spark, links_table).select("cve_id", "exploit_id")
    fresh = new.join(known.hint("merge"), ["cve_id", "exploit_id"], "left_anti")
    before = stored_table(spark, links_table).count()
    _save(fresh, links_table, "cve_id", buckets, "append")
    return stored_table(spark, links_table).count() - before


def stored_links(spark: SparkSession, cves_table: str, links_table: str) -> DataFrame:
    """Each link with its advisory, joined bucket by bucket."""
    cves = stored_table(spark, cves_table).withColumnRenamed("id", "cve_id")
    return stored_table(spark, links_table).select("cve_id", "exploit_id", "type", "platform").join(cves.hint("merge"), "cve_id")


def stored_lookup(spark: SparkSession, cves_table: str, links_table: str, cve_id: str) -> DataFrame:
    """The exploits of one known advisory, from one bucket of each table; empty if there are none or the id is unknown."""
    wanted = cve_id.upper()
    known = stored_table(spark, cves_table).filter(F.col("id") == wanted).select(F.col("id").alias("cve_id"))
    named = stored_table(spark, links_table).filter(F.col("cve_id") == wanted)
    return named.withColumnRenamed("exploit_id", "exploitdb_id").join(known.hint("merge"), "cve_id", "left_semi")
