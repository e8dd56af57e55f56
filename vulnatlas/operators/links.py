"""Links between exploits and advisories, and completeness reports between key sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vulnatlas.functions.columns import basename

NESTED_FIELDS = ("exploitdb_id", "description", "type", "platform", "markdown", "url")


def link_exploits(exploits: DataFrame, *columns: str) -> DataFrame:
    """One row per exploit and distinct CVE id it names."""
    return exploits.select(
        F.explode(F.array_distinct("cves")).alias("cve_id"), F.col("id").alias("exploit_id"), *columns
    )


def exploit_cve_map(exploits: DataFrame) -> DataFrame:
    """The CVE ids of each exploit that names any. They are in one row already, so nothing is grouped."""
    return exploits.filter(F.size("cves") > 0).select(F.col("id").alias("exploit_id"), "cves")


def exploits_of_advisories(cves: DataFrame, exploits: DataFrame, *columns: str) -> DataFrame:
    """Inner join on the whole id. An advisory many exploits name is a skewed key on the link
    side only; adaptive execution splits it, as nothing after the join needs its partitioning."""
    return link_exploits(exploits, *columns).join(cves.withColumnRenamed("id", "cve_id"), "cve_id")


def nested_exploits(exploits: DataFrame, block: int | None = None) -> DataFrame:
    """Exploits of each CVE as arrays of structs, one row per CVE.

    With ``block``, a row holds that many consecutive exploit ids at most, however many exploits name the
    same CVE. For tables without a bound on that, :func:`exploits_of_advisories` is the flat form.
    """
    links = link_exploits(
        exploits,
        F.struct(F.col("id").alias("exploitdb_id"), *NESTED_FIELDS[1:]).alias("exploit"),
    )
    part = F.lit(0) if block is None else F.expr(f"exploit_id div {block}")
    return links.groupBy("cve_id", part.alias("block")).agg(F.sort_array(F.collect_list("exploit")).alias("exploits"))


def advisories_with_exploits(cves: DataFrame, exploits: DataFrame, block: int | None = None) -> DataFrame:
    """Every advisory with its nested exploits, by blocks if asked; one row, null and empty, where there are none.

    Matched and unmatched advisories come from an inner and an anti join rather than one outer
    join: only an inner join lets a skewed exploit side be split.
    """
    nested = nested_exploits(exploits, block)
    matched = nested.withColumnRenamed("cve_id", "id").join(cves, "id")
    unmatched = cves.join(link_exploits(exploits).select(F.col("cve_id").alias("id")).distinct(), "id", "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)


def missing_files(listed: DataFrame, present: DataFrame, file: str = "file") -> DataFrame:
    """Distinct listed files whose base name is not among those present."""
    wanted = listed.filter(F.col(file) != "").withColumn("basename", basename(F.col(file)))
    return wanted.join(present.select("basename"), "basename", "left_anti").select(file).distinct()


def coverage_gap(enrichment: DataFrame, cves: DataFrame, key: str = "id") -> DataFrame:
    """Enrichment rows about advisories that are not in the advisory table."""
    return enrichment.join(cves.select(F.col("id").alias(key)), key, "left_anti")
