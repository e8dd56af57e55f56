"""Every query over the driver's tables: ``(spark, sf_dir) -> DataFrame``, on whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vulnatlas.functions import columns as C
from vulnatlas.functions.text import tokens
from vulnatlas.operators import diffs, enrichment, filters, limits, link_store, links, matching, merging, normalize, segments, summaries
from vulnatlas.operators import match_tree as T
from vulnatlas.operators.postings import write_postings
from vulnatlas.plans import driver_tables as D
from vulnatlas.plans import pipeline
from vulnatlas.plans import queries as Q
from vulnatlas.plans import stats as S
from vulnatlas.session import shared_path
from vulnatlas.sinks import writers
from vulnatlas.sources import exploits as exploit_source
from vulnatlas.sources import jsonl, tables, writeups
from vulnatlas.streaming.ingest import ingest_indexed, ingest_indexed_feeds, ingest_landed, ingest_latest, latest_state

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def joined(array) -> Column:
    return F.array_join(array, ",")


# --- normalisation -------------------------------------------------------------------------


@query
def advisories(spark, sf_dir):
    return D.cves(spark, sf_dir)


@query
def normalize_advisories(spark, sf_dir):
    rows = normalize.normalize_advisories(D.feed_items(spark, sf_dir))
    return rows.select(
        "id", "published", "severity", "cvss", "cwe", "description", joined("refs").alias("refs"),
        joined("ref_tags").alias("ref_tags"), "source", "status", "cvss_vector", "last_modified", "year",
    )


@query
def metric_precedence(spark, sf_dir):
    metric = C.preferred_metric(F.col("cve.metrics"), normalize.METRIC_PRECEDENCE)
    items = D.feed_items(spark, sf_dir).select(F.col("cve.id").alias("id"), metric.alias("metric"))
    return items.select(
        "id", F.col("metric.cvssData.baseScore").alias("cvss"), C.metric_severity(F.col("metric")).alias("severity")
    )


@query
def first_cwe(spark, sf_dir):
    items = D.feed_items(spark, sf_dir)
    return items.select(F.col("cve.id").alias("id"), C.first_cwe(F.col("cve.weaknesses")).alias("cwe"))


@query
def exploits_base(spark, sf_dir):
    rows = D.exploits(spark, sf_dir)
    return rows.withColumn("cves", joined("cves")).withColumn("tags", joined("tags"))


@query
def exploit_ids(spark, sf_dir):
    return D.exploits(spark, sf_dir).select("id", "verified", "markdown", "source", "url")


@query
def exploit_cards(spark, sf_dir):
    return normalize.exploit_cards(D.catalogue(spark, sf_dir))


@query
def split_codes_counts(spark, sf_dir):
    return D.exploits(spark, sf_dir).groupBy(F.size("cves").alias("codes")).agg(F.count("*").alias("n"))


@query
def tags_split(spark, sf_dir):
    return D.exploits(spark, sf_dir).select("id", joined("tags").alias("tags"))


@query
def writeup_index(spark, sf_dir):
    return normalize.index_writeups(D.writeup_files(spark, sf_dir))


@query
def doc_title(spark, sf_dir):
    return D.table(spark, sf_dir, "documents").select("doc_id", C.text_title(F.col("text")).alias("title"))


@query
def doc_slug(spark, sf_dir):
    return D.table(spark, sf_dir, "documents").select("doc_id", C.slug(F.col("text")).alias("slug"))


@query
def page_basename(spark, sf_dir):
    return D.table(spark, sf_dir, "pages").select("page_id", C.basename(F.col("url")).alias("basename"))


@query
def json_field(spark, sf_dir):
    events = D.table(spark, sf_dir, "events")
    return events.select("event_id", F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint").alias("k"))


@query
def first_assistant(spark, sf_dir):
    """First text in the wanted role per conversation, as a partial aggregate rather than a list."""
    turn = F.when(F.col("role") == "assistant", F.col("turn"))
    return D.table(spark, sf_dir, "conversations").groupBy("conv_id").agg(
        C.or_empty(F.min_by("text", turn)).alias("text")
    )


@query
def ref_tags(spark, sf_dir):
    """Distinct roles in first-seen order: first turn per role, then one short list per conversation."""
    first = D.table(spark, sf_dir, "conversations").groupBy("conv_id", "role").agg(F.min("turn").alias("turn"))
    ordered = F.sort_array(F.collect_list(F.struct("turn", "role")))
    return first.groupBy("conv_id").agg(joined(F.transform(ordered, lambda r: r["role"])).alias("roles"))


# --- search --------------------------------------------------------------------------------




@query
def token_counts(spark, sf_dir):
    return D.cves(spark, sf_dir).select("id", F.size(tokens(F.col("description"))).alias("n_tokens"))


@query
def postings(spark, sf_dir):
    rows = D.postings(spark, sf_dir)
    return rows.select("id", "field", "token", F.size("positions").alias("n"), joined("positions").alias("positions"))


@query
def postings_index(spark, sf_dir):
    """Postings written in search layout and read back: documents and occurrences per token."""
    index = write_postings(D.postings(spark, sf_dir), shared_path(spark, "postings"))
    return index.groupBy("token", "field").agg(
        F.count("*").alias("documents"), F.sum(F.size("positions")).alias("occurrences")
    )


@query
def match_all(spark, sf_dir):
    words = ["the", "with", "from"]
    return matching.match_all(D.postings(spark, sf_dir, words), words)


@query
def match_any(spark, sf_dir):
    words = ["vivi", "ouing", "quequ"]
    return matching.match_any(D.postings(spark, sf_dir, words), words)


@query
def match_none(spark, sf_dir):
    words = ["the", "que"]
    return matching.match_none(D.cves(spark, sf_dir), D.postings(spark, sf_dir, words), words)


@query
def match_prefix(spark, sf_dir):
    return matching.match_prefix(D.postings(spark, sf_dir), "ingre")


@query
def match_phrase(spark, sf_dir):
    words = ["of", "the"]
    return matching.match_phrase(D.postings(spark, sf_dir, words), words)


@query
def match_near(spark, sf_dir):
    return matching.match_near(D.postings(spark, sf_dir, ["and", "the"]), "and", "the", 3)


@query
def match_first(spark, sf_dir):
    return matching.match_first(D.postings(spark, sf_dir, ["the"]), "the")


@query
def match_field(spark, sf_dir):
    return matching.match_all(D.postings(spark, sf_dir, ["2024"]), ["2024"], field="id")


@query
def search_filtered(spark, sf_dir):
    return Q.search(
        D.postings(spark, sf_dir, ["the"]), D.cves(spark, sf_dir), "the", stem=False,
        severity="critical, high", since=2005, min_cvss=3.0, limit=50,
    )


@query
def search_all_filters(spark, sf_dir):
    return Q.search(
        D.postings(spark, sf_dir, ["the", "of", "and"]), D.cves(spark, sf_dir), ["and", "of_the"], stem=False,
        severity="HIGH,MEDIUM,LOW", cwe="cwe-8", exact_cwe=False, since=2000, limit=None,
    )


def delivered_index(spark, sf_dir, **made) -> str:
    """A search index of all advisories in two deliveries, the second of which holds the first's rows too."""
    root, rows = shared_path(spark, "index"), D.cves(spark, sf_dir)
    for delivery in (rows.filter("status <> 'en'"), rows):
        segments.append_segment(spark, delivery, root, **{"stem": False, "substring": None} | made)
    return root


@query
def append_then_search(spark, sf_dir):
    """Two deliveries that overlap, folded into one segment, then searched."""
    root = delivered_index(spark, sf_dir)
    segments.merge_segments(spark, root)
    found = segments.search_index(
        segments.open_index(spark, root), T.all_of("and", "of the"), None,
        severity="HIGH,MEDIUM,LOW", cwe="cwe-8", exact_cwe=False, since=2000)
    return found.select(*Q.ADVISORY_RESULT)


@query
def merge_segments(spark, sf_dir):
    """The vocabulary after a merge."""
    root = delivered_index(spark, sf_dir)
    segments.merge_segments(spark, root)
    return segments.open_index(spark, root).terms()


@query
def prefix_search(spark, sf_dir):
    """A prefix in one of the live segments' vocabularies, best score first."""
    index = segments.open_index(spark, delivered_index(spark, sf_dir))
    return segments.search_index(index, T.prefix("Ingre"), 30, severity="high", since=2005).select(*Q.ADVISORY_RESULT)


@query
def search_or_not(spark, sf_dir):
    index = segments.open_index(spark, delivered_index(spark, sf_dir))
    tree = T.But(T.any_of("vivi", "ouing", T.all_of("the", "from")), T.Words("with"))
    return segments.search_index(index, tree, 40, min_cvss=2.0).select(*Q.ADVISORY_RESULT)


@query
def search_prefix_filtered(spark, sf_dir):
    """A phrase with an open end and a first word, over stems."""
    index = segments.open_index(spark, delivered_index(spark, sf_dir, stem=True))
    tree = T.any_of(T.all_of(T.prefix("of th"), "reating"), T.Words("of", "description", first=True))
    return segments.search_index(index, tree, None, severity="CRITICAL", since=2003).select(*Q.ADVISORY_RESULT)


@query
def near_phrases(spark, sf_dir):
    index = segments.open_index(spark, delivered_index(spark, sf_dir))
    return segments.matching_ids(index, T.Near(("of the", "and", "to"), 4, "description"))


@query
def search_top_scored(spark, sf_dir):
    """The best rows that hold a frequent word: blocks of lower scores stay unread."""
    index = segments.open_index(spark, delivered_index(spark, sf_dir))
    return segments.search_index(index, T.Words("The"), 25).select(*Q.ADVISORY_RESULT)


@query
def substring_search(spark, sf_dir):
    index = segments.open_index(spark, delivered_index(spark, sf_dir, substring="description"))
    return segments.substring_search(index, "ION THE", None, severity="high").select(*Q.ADVISORY_RESULT)


@query
def stream_then_search(spark, sf_dir):
    """Advisories that land in two batches become searchable with each."""
    landing, root, checkpoint = (shared_path(spark, name) for name in ("landing", "index", "checkpoint"))
    rows = D.cves(spark, sf_dir)
    for delivery in (rows.filter("status <> 'en'"), rows):
        delivery.write.mode("append").parquet(landing)
        ingest_indexed(spark.readStream.schema(rows.schema).parquet(landing), root, checkpoint, stem=False, substring=None)
    found = segments.search_index(
        segments.open_index(spark, root), T.Words("the", "description"), 50, severity="critical, high", since=2005, min_cvss=3.0)
    return found.select(*Q.ADVISORY_RESULT)


@query
def scan_search(spark, sf_dir):
    return Q.scan_search(
        D.cves(spark, sf_dir), ["and", "of the"], severity="HIGH,MEDIUM,LOW", cwe="cwe-8", exact_cwe=False,
        since=2000, limit=None,
    )


@query
def stemmed_search(spark, sf_dir):
    index = D.postings(spark, sf_dir, ["tion", "reat"], stem=True)
    return Q.search(index, D.cves(spark, sf_dir), ["tions", "reating"], limit=None)


@query
def stemmed_postings(spark, sf_dir):
    rows = D.postings(spark, sf_dir, stem=True)
    return rows.groupBy("token").agg(F.count("*").alias("fields"), F.sum(F.size("positions")).alias("occurrences"))


@query
def product_search(spark, sf_dir):
    return Q.product(D.cves(spark, sf_dir), "TION", since=2010, severity="high", cwe="CWE-73,CWE-81", limit=40)


@query
def lookup_cve(spark, sf_dir):
    cves = D.cves(spark, sf_dir).withColumns({"refs": F.array("source"), "ref_tags": F.array("status")})
    found = Q.lookup(cves, "cve-2006-00007")
    return found.withColumn("references", joined("references")).withColumn("refTags", joined("refTags"))


@query
def lookup_exploits(spark, sf_dir):
    rows = Q.lookup_exploits(D.cves(spark, sf_dir), D.exploits(spark, sf_dir), "CVE-2006-00007")
    return rows.select("cve_id", "block", F.inline("exploits"))


@query
def cwe_exact(spark, sf_dir):
    return D.cves(spark, sf_dir).filter(filters.cwe_in("cwe-75, CWE-8")).select("id", "cwe")


@query
def cwe_substring(spark, sf_dir):
    return D.cves(spark, sf_dir).filter(filters.cwe_in("cwe-75, CWE-8", exact=False)).select("id", "cwe")


@query
def exploit_search(spark, sf_dir):
    found = Q.exploits(D.exploits(spark, sf_dir), "Purchase", "LIN", limit=100)
    return found.withColumn("cves", joined("cves"))


@query
def exploits_on_platform(spark, sf_dir):
    found = Q.exploits(D.exploits(spark, sf_dir), platform="php", limit=None)
    return found.withColumn("cves", joined("cves"))


@query
def writeup_search(spark, sf_dir):
    return Q.writeups(normalize.index_writeups(D.writeup_files(spark, sf_dir)), "Th", limit=None)


@query
def page_writeups(spark, sf_dir):
    pages = D.table(spark, sf_dir, "pages").selectExpr("url AS path", "html AS title", "'' AS repo", "length(html) AS size")
    return Q.writeups(pages, "SPAM-farm", limit=None).select("path", "size")


@query
def sql_join(spark, sf_dir):
    """Free SQL over the registered tables: hits joined to their advisories, best score first."""
    rows = {"cves": D.cves(spark, sf_dir), "cves_postings": D.postings(spark, sf_dir, ["with"])}
    return Q.sql(spark, rows, """
        SELECT c.id, c.severity, c.cvss, c.cwe, c.description
        FROM cves_postings p JOIN cves c ON p.id = c.id
        WHERE p.token = 'with' ORDER BY c.cvss DESC NULLS LAST, c.id LIMIT 20""")


# --- links ---------------------------------------------------------------------------------


@query
def exploit_cve_map(spark, sf_dir):
    return links.exploit_cve_map(D.exploits(spark, sf_dir)).select("exploit_id", joined("cves").alias("cves"))


@query
def cve_exploits(spark, sf_dir):
    rows = links.exploits_of_advisories(
        D.cves(spark, sf_dir).select("id", "severity", "cvss"), D.exploits(spark, sf_dir), "type", "platform"
    )
    return rows.select("cve_id", "severity", "cvss", "exploit_id", "type", "platform")


@query
def cve_with_exploits(spark, sf_dir):
    rows = links.advisories_with_exploits(D.cves(spark, sf_dir).select("id", "severity"), D.exploits(spark, sf_dir), block=1000)
    ids = F.transform("exploits", lambda e: e["exploitdb_id"])
    return rows.select(
        "id", "severity", "block", F.coalesce(F.size("exploits"), F.lit(0)).alias("n"), joined(ids).alias("exploit_ids")
    )


def bucketed(spark, sf_dir) -> tuple[str, str]:
    """Advisories and links stored by buckets, the second half of the exploits added afterwards, twice."""
    names = tuple(f"{name}_{uuid.uuid4().hex}" for name in ("cves_by_id", "exploit_links"))
    exploits = D.exploits(spark, sf_dir)
    link_store.store_links(D.cves(spark, sf_dir).select("id", "severity", "cvss"), exploits.filter("verified"), *names)
    for _ in range(2):
        link_store.add_links(exploits, names[1])
    return names


@query
def stored_cve_exploits(spark, sf_dir):
    """Stored links joined bucket by bucket."""
    return link_store.stored_links(spark, *bucketed(spark, sf_dir)).select("cve_id", "severity", "cvss", "exploit_id", "type", "platform")


@query
def stored_lookup(spark, sf_dir):
    """Exploits of one advisory from one bucket."""
    rows = link_store.stored_lookup(spark, *bucketed(spark, sf_dir), "cve-2006-00007")
    return rows.select("cve_id", "exploitdb_id", "description", "type", "platform", "markdown", "url")


@query
def exploit_counts(spark, sf_dir):
    """Exploits per advisory, counted before the join so that a hot advisory is one row."""
    counts = links.link_exploits(D.exploits(spark, sf_dir)).groupBy("cve_id").agg(F.count("*").alias("n"))
    return D.cves(spark, sf_dir).select("id").join(counts.withColumnRenamed("cve_id", "id"), "id", "left").fillna(0, ["n"])


@query
def coverage_gap(spark, sf_dir):
    known = D.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"))
    rows = D.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "lang", "source")
    return links.coverage_gap(rows, known)


@query
def missing_files(spark, sf_dir):
    listed = D.table(spark, sf_dir, "pages").select(F.col("url").alias("file"))
    keys = D.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("basename"))
    return links.missing_files(listed, keys)


# --- summaries -----------------------------------------------------------------------------


@query
def table_counts(spark, sf_dir):
    return S.table_counts({"cves": D.cves(spark, sf_dir), "exploits": D.exploits(spark, sf_dir)})


@query
def severity_counts(spark, sf_dir):
    return S.severity_counts(D.cves(spark, sf_dir))


@query
def top_cwe(spark, sf_dir):
    return S.top_cwe(D.cves(spark, sf_dir))


@query
def top_scored(spark, sf_dir):
    return S.top_scored_prefixes(D.cves(spark, sf_dir))


@query
def year_counts(spark, sf_dir):
    return S.year_counts(D.cves(spark, sf_dir))


@query
def stats(spark, sf_dir):
    files = normalize.index_writeups(D.writeup_files(spark, sf_dir))
    return S.stats(D.cves(spark, sf_dir), D.exploits(spark, sf_dir), files, ["hf_vuln_patches", "hf_vuln_scores"])


@query
def kept_summaries(spark, sf_dir):
    """Summaries merged from those of two deliveries and a merge, without reading an advisory again."""
    root = delivered_index(spark, sf_dir)
    parts = segments.open_index(spark, root).part("summary")
    segments.merge_segments(spark, root)
    merged = segments.open_index(spark, root).part("summary")

    def section(name, df, item):
        return df.select(F.lit(name).alias("section"), F.col(item).alias("item"), "n")

    return section("by_severity", summaries.kept_severity_counts(parts), "severity").unionAll(
        section("top_cwe", summaries.kept_top_cwe(merged), "cwe")).unionAll(section("by_year", summaries.kept_year_counts(merged), "year"))


# --- enrichment ----------------------------------------------------------------------------


def two_tables(spark, sf_dir):
    return {
        "hf_benchmark": D.table(spark, sf_dir, "benchmark").selectExpr("item_id AS id", "text AS description"),
        "hf_documents": D.table(spark, sf_dir, "documents").selectExpr(
            "doc_id AS id", "source AS title", "text AS description", "lang"),
        "hf_pages": D.table(spark, sf_dir, "pages"),
    }


@query
def any_table_search(spark, sf_dir):
    return enrichment.search_tables(two_tables(spark, sf_dir), "Ingre", limit=7)


@query
def match_counts(spark, sf_dir):
    return enrichment.match_counts(enrichment.search_tables(two_tables(spark, sf_dir), "with"))


@query
def patch_search(spark, sf_dir):
    found = enrichment.patch_search(D.patches(spark, sf_dir), "SRC1", limit=25)
    return found.select("id", "title", "cwe")


@query
def decoded_patch_search(spark, sf_dir):
    found = enrichment.decoded_patch_search(D.patches(spark, sf_dir), "of the", limit=None)
    return found.withColumn("cwe", joined("cwe"))


@query
def b64_roundtrip(spark, sf_dir):
    return enrichment.decoded_patches(D.patches(spark, sf_dir)).select("id", "n", "diff")


@query
def patch_lines(spark, sf_dir):
    """Lines of unified diffs by file, hunk, side and number; removed and added lines look like file headers."""
    return diffs.diff_lines(D.unified_patches(spark, sf_dir))


@query
def changed_lines(spark, sf_dir):
    return diffs.changed_lines(D.unified_patches(spark, sf_dir), "SRC1", side="added", file="/en")


@query
def text_compat(spark, sf_dir):
    return enrichment.text_view(D.exploits(spark, sf_dir))


@query
def json_text_arrays(spark, sf_dir):
    """Arrays to JSON text and back."""
    text = enrichment.with_text_arrays(D.exploits(spark, sf_dir).select("id", "cves", "tags"))
    return text.select("id", joined(C.json_array(F.col("cves"))).alias("cves"), joined(C.json_array(F.col("tags"))).alias("tags"))


@query
def lenient_json(spark, sf_dir):
    """Parsed where the text is JSON, the text itself kept beside it where it is not."""
    rows = D.table(spark, sf_dir, "events").selectExpr(
        "event_id", "CASE WHEN event_type = 'click' THEN event_type ELSE props END AS patches")
    parsed = enrichment.with_parsed_json(rows, "patches")
    return parsed.select("event_id", "patches", F.try_variant_get("patches_json", "$.k", "bigint").alias("k"))


@query
def ndjson_rows(spark, sf_dir):
    return writers.result_lines(D.cves(spark, sf_dir).select("id", "published", "severity", "cwe", "source"))


@query
def shard_union(spark, sf_dir):
    return tables.read_shards(spark, [f"{sf_dir}/documents.parquet", f"{sf_dir}/benchmark.parquet"])


@query
def any_jsonl(spark, sf_dir):
    path = shared_path(spark, "any-jsonl")
    for name in ("documents", "benchmark"):
        writers.write_json_lines(D.table(spark, sf_dir, name), path, mode="append")
    return jsonl.read_any(spark, path)


@query
def enrichment_datasets(spark, sf_dir):
    """Datasets landed with sidecars, discovered, and counted by table and column."""
    path = shared_path(spark, "enrichment")
    writers.land_enrichment(D.table(spark, sf_dir, "documents"), "own/documents", path, "hf_documents")
    writers.land_enrichment(D.table(spark, sf_dir, "labels"), "own/labels", path, "hf_labels")
    found = tables.discover_enrichment(spark, path)
    return S.table_counts({f"{name}: {joined_names(df)}": df for name, df in found.items()})


@query
def provenance(spark, sf_dir):
    path = shared_path(spark, "enrichment")
    for name in ("documents", "labels", "pages"):
        writers.land_enrichment(D.table(spark, sf_dir, name), f"own/{name}", path, f"hf_{name}")
    return tables.read_provenance(spark, path).select("dataset", "mode", "config", "split", "rows", "table")


def joined_names(df: DataFrame) -> str:
    return ",".join(df.columns)


@query
def enrichment_build(spark, sf_dir):
    """Datasets whose names begin alike, built into catalog tables twice, listed and read back."""
    path, mark = shared_path(spark, "enrichment"), f"hf_{uuid.uuid4().hex}_"
    for table, name in (("labels", "own"), ("benchmark", "own__new"), ("events", "own__old")):
        writers.land_enrichment(D.table(spark, sf_dir, table), name, path, f"{mark}{name}")
    for _ in range(2):
        pipeline.build(spark, shared_path(spark, "postings"), enrichment_dir=path)
    stored = [name for name in tables.enrichment_tables(spark) if name.startswith(mark)]
    return S.table_counts({f"{name.removeprefix(mark)}: {joined_names(df)}": df for name, df in tables.existing_tables(spark, stored).items()})


# --- landing, merging and publishing -------------------------------------------------------


def landed_feeds(spark, sf_dir) -> str:
    """A folder of feed documents, one file for each year and language, written item by item by a task each."""
    path = shared_path(spark, "feeds")
    items = D.feed_items(spark, sf_dir).select(
        C.published_year(F.col("cve.published")).alias("year"), F.col("source_order.file").alias("file"), F.col("source_order.n").alias("n"), "raw")
    documents = D.table(spark, sf_dir, "documents").filter(f"{D.CVE_ID} <> ''")
    feeds = documents.select(C.published_year(F.expr(D.PUBLISHED)), "lang").distinct().collect()
    numbers = spark.createDataFrame([(*feed, k) for k, feed in enumerate(feeds)], "year string, file string, feed int")
    numbered = items.join(F.broadcast(numbers), items["year"].eqNullSafe(numbers["year"]) & items["file"].eqNullSafe(numbers["file"]))
    ends = numbers.select("feed", F.lit(None).cast("bigint").alias("n"), F.lit(None).cast("string").alias("raw"))
    lines = numbered.select("feed", "n", "raw").unionAll(ends).repartitionById(max(1, len(feeds)), "feed")
    lines = lines.sortWithinPartitions(F.col("raw").isNull(), "n").withColumn("line", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    begun = F.when(F.col("line") == 0, '{"vulnerabilities":[').otherwise(",")
    lines.select(F.when(F.col("raw").isNull(), "]}").otherwise(F.concat(begun, "raw"))).write.option("compression", "gzip").text(path)
    return path


@query
def feeds_then_search(spark, sf_dir):
    """Feed documents landed, ingested into a search index as a stream, delivered again as a batch, and searched."""
    landing, root, checkpoint = landed_feeds(spark, sf_dir), shared_path(spark, "index"), shared_path(spark, "checkpoint")
    ingest_indexed_feeds(spark, landing, root, checkpoint, stem=False, substring=None)
    pipeline.append_indexed(spark, f"{landing}/*.gz", root, stem=False, substring=None)
    found = segments.search_index(segments.open_index(spark, root), T.all_of("the", T.prefix("ingre")), 25, since=2001)
    return found.select(*Q.ADVISORY_RESULT)


@query
def feed_files(spark, sf_dir):
    """Feed documents written, scanned and built into the advisory table."""
    rows = pipeline.advisory_table(spark, f"{landed_feeds(spark, sf_dir)}/*.gz")
    return rows.select("id", "published", "severity", "cvss", "cwe", "description", "source", "status", "year")


@query
def published_state(spark, sf_dir):
    """Two tables published together, one of them published anew, both read as of the newest state."""
    root = shared_path(spark, "state")
    cves = D.cves(spark, sf_dir).select("id", "severity")
    writers.publish_together(spark, root, {"cves": cves.limit(0), "exploits": D.exploits(spark, sf_dir).select("id", "platform")}, {"exploits": "id"})
    writers.publish_together(spark, root, {"cves": cves}, {"cves": "id"})
    found = tables.read_together(spark, root)
    return found["cves"].selectExpr("'cves' AS `table`", "id", "severity AS item").unionAll(
        found["exploits"].selectExpr("'exploits'", "CAST(id AS STRING)", "platform"))



@query
def catalogue_csv(spark, sf_dir):
    """Whole texts with quotes and line breaks written as CSV and scanned as a catalogue."""
    path = shared_path(spark, "catalogue")
    rows = D.table(spark, sf_dir, "documents").selectExpr(
        "CAST(doc_id AS STRING) AS id", "text AS description", "'\"' || lang || '\",' || source AS tags", "'' AS port")
    rows.write.options(header=True, quote='"', escape='"', quoteAll=True).csv(path)
    return exploit_source.read_catalogue(spark, path).select("id", "description", "tags", "port", "codes")


@query
def jsonl_index(spark, sf_dir):
    """An index with one cut-off line per advisory among the good ones."""
    path = shared_path(spark, "index")
    rows = D.cves(spark, sf_dir).withColumnRenamed("cvss", "cvssScore")
    good = writers.result_lines(rows)
    bad = good.select(F.expr("left(line, length(line) - 2)").alias("line"))
    good.union(bad).write.text(path)
    index = jsonl.read_index(spark, path, jsonl.ADVISORY_INDEX)
    cves = normalize.advisories_from_index(index)
    return cves.select("id", "published", "severity", "cvss", "cwe", "description", "source", "status", "year")


@query
def document_store(spark, sf_dir):
    """Raw documents stored by year, delivered twice, and the years 2005 to 2010 read back."""
    path = shared_path(spark, "documents")
    items = D.feed_items(spark, sf_dir)
    writers.write_documents(items, path)
    writers.write_documents(items, path)
    stored = spark.read.parquet(path).filter(F.col("year").between(2005, 2010))
    return stored.select(
        "id", F.col("year").cast("string").alias("year"),
        F.get_json_object("raw", "$.cve.descriptions[1].value").alias("text"),
    )


@query
def row_budget(spark, sf_dir):
    """A development scan that stops after a number of feed items."""
    items = D.feed_items(spark, sf_dir)
    return limits.first_rows(items, 100, "source_order").select(F.col("cve.id").alias("id"))


def deliveries(spark, sf_dir):
    """A first delivery without the English documents and a second one of all documents."""
    rows = D.table(spark, sf_dir, "documents").selectExpr(f"{D.CVE_ID} AS id", "text", "lang")
    first = rows.filter("lang <> 'en'").withColumn("delivery", F.lit("first"))
    return first, rows.withColumn("delivery", F.lit("second"))


@query
def append_new(spark, sf_dir):
    path = shared_path(spark, "append")
    first, second = deliveries(spark, sf_dir)
    for rows in (first.union(first), second, second):
        writers.append_new(rows, path, "id", "delivery", "text")
    return spark.read.parquet(path)


@query
def ingest_stream(spark, sf_dir):
    landing, target, checkpoint = (shared_path(spark, name) for name in ("landing", "target", "checkpoint"))
    for rows in deliveries(spark, sf_dir):
        rows.write.mode("append").parquet(landing)
        stream = spark.readStream.schema(rows.schema).parquet(landing)
        ingest_landed(stream, target, checkpoint, order=("delivery", "text"))
    return spark.read.parquet(target)


@query
def stream_latest(spark, sf_dir):
    """Three deliveries, the newest rows in the second: the latest row of each id, whatever lands after it."""
    landing, target, checkpoint = (shared_path(spark, name) for name in ("landing", "target", "checkpoint"))
    rows = D.cves(spark, sf_dir).select("id", "severity", "description")
    for day, part in (("2024-01-02", "severity = 'HIGH'"), ("2024-01-03", "severity <> 'LOW'"), ("2024-01-01", "true")):
        rows.filter(part).withColumn("last_modified", F.lit(day)).write.mode("append").parquet(landing)
        stream = spark.readStream.schema("id string, severity string, description string, last_modified string").parquet(landing)
        ingest_latest(stream, target, checkpoint)
    return latest_state(spark, target)


@query
def writeup_files(spark, sf_dir):
    """Writeups written as files, scanned, and what the scan leaves out."""
    path = shared_path(spark, "writeups")
    rows = D.table(spark, sf_dir, "benchmark").selectExpr("text AS value", "CAST(item_id % 3 AS STRING) AS part")
    rows.write.option("maxRecordsPerFile", 1).partitionBy("part").text(f"{path}/read")
    rows.select("value").write.option("maxRecordsPerFile", 10).csv(f"{path}/left")
    read = normalize.index_writeups(writeups.read_writeups(spark, path)).select("title", F.lit("").alias("reason"))
    left = writeups.skipped_writeups(spark, path).select(F.lit("").alias("title"), "reason").distinct()
    return read.unionAll(left)


@query
def dedup_first(spark, sf_dir):
    turns = D.table(spark, sf_dir, "conversations")
    return merging.one_per_key(turns, "conv_id", "turn", "role", "text")


@query
def latest_wins(spark, sf_dir):
    first, second = deliveries(spark, sf_dir)
    return merging.latest_rows(first, second, "id", "delivery")


def link_map(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """A link map, and new entries for some of its keys."""
    old = D.exploits(spark, sf_dir).select(F.col("id").alias("exploit_id"), joined("cves").alias("cves"))
    entry = F.concat(F.lit("new:"), joined("tags"))
    new = D.exploits(spark, sf_dir).filter("verified").select(F.col("id").alias("exploit_id"), entry.alias("cves"))
    return old, new


@query
def map_upsert(spark, sf_dir):
    return merging.upsert(*link_map(spark, sf_dir), "exploit_id")


@query
def table_upsert(spark, sf_dir):
    """The link map as a catalog table: replaced, new entries merged in twice, read back."""
    name = f"link_map_{uuid.uuid4().hex}"
    old, new = link_map(spark, sf_dir)
    writers.replace_table(old, name, "exploit_id")
    writers.upsert_table(new, name, "exploit_id")
    return writers.upsert_table(new.union(new), name, "exploit_id")


@query
def duplicate_keys(spark, sf_dir):
    return merging.duplicate_keys(D.table(spark, sf_dir, "conversations"), "conv_id")


@query
def export_roundtrip(spark, sf_dir):
    path = shared_path(spark, "published")
    writers.publish({"cves": D.cves(spark, sf_dir)}, path)
    return tables.read_published(spark, path, "cves")


@query
def export_parts(spark, sf_dir):
    """Scores published in 15 parts, read back as one dataset: rows per part add up."""
    path = shared_path(spark, "published")
    scores = D.cves(spark, sf_dir).select("id", "cvss", "severity")
    writers.publish({"hf_vuln_scores": scores}, path, {"scores": 15})
    return tables.read_published(spark, path, "scores")


@query
def export_counts(spark, sf_dir):
    path = shared_path(spark, "published")
    written = writers.publish({"cves": D.cves(spark, sf_dir), "exploits": D.exploits(spark, sf_dir)}, path)
    counts = spark.createDataFrame(list(written.items()), "table string, n bigint")
    read = S.table_counts({name: tables.read_published(spark, path, name) for name in written})
    return counts.join(read.withColumnRenamed("n", "read_back"), "table")
