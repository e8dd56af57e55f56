"""Registered queries of this subpackage: ``(spark, sf_dir) -> DataFrame`` over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from vulnatlas.llm import conversation_trie, decontamination, html_extraction, minhash_dedup, periodic_runs, quality_classifier, quality_rules, sentencepiece_sampling, substring_dedup, token_counts, token_files, toxicity, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(run):
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_minhash_near_dedup(spark, sf_dir):
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), width=2, percent=80)


ORACLES["op1_minhash_near_dedup"] = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) = 1 THEN w
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM worded
), sized AS (SELECT doc_id, s, len(s) AS n FROM sets
), pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, a.n AS nx, b.n AS ny, len(list_intersect(a.s, b.s)) AS n_shared
  FROM sized a JOIN sized b ON a.doc_id < b.doc_id AND a.n > 0 AND b.n > 0 AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
), links AS (
  SELECT x, y FROM pairs WHERE 100 * n_shared >= 80 * (nx + ny - n_shared)
), ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reached AS (
  SELECT doc_id AS node, doc_id AS other FROM documents
  UNION SELECT r.node, w.y FROM reached r JOIN ways w ON r.other = w.x
), least_of AS (SELECT node, min(other) AS component_id FROM reached GROUP BY node)
SELECT s.doc_id, CAST(s.n AS BIGINT) AS n_shingles, l.component_id, s.doc_id = l.component_id AS kept
FROM sized s JOIN least_of l ON s.doc_id = l.node
"""


@query
def op3_substring_dedup(spark, sf_dir):
    return substring_dedup.digest(substring_dedup.without_repeats(table(spark, sf_dir, "documents")))


ORACLES["op3_substring_dedup"] = r"""
WITH worded AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), placed AS (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM worded WHERE len(w) >= 13
), windows AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s FROM placed
), least_of AS (SELECT s, min(doc_id) AS first_doc FROM windows GROUP BY s
), gone AS (
  SELECT doc_id, list(DISTINCT j) AS g FROM (
    SELECT w.doc_id, unnest(range(w.i, w.i + 13)) AS j FROM windows w JOIN least_of l ON w.s = l.s WHERE w.doc_id > l.first_doc
  ) GROUP BY doc_id
), kept AS (
  SELECT d.doc_id, len(d.w) AS n, CASE WHEN g.g IS NULL THEN d.w
    ELSE list_transform(list_filter(range(1, len(d.w) + 1), lambda j: NOT list_contains(g.g, j)), lambda j: d.w[j]) END AS k
  FROM worded d LEFT JOIN gone g ON d.doc_id = g.doc_id
)
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(n - len(k) AS BIGINT) AS n_removed,
  sha256(array_to_string(k, ' ')) AS kept_sha256 FROM kept
"""


@query
def op10_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = toxicity.trained(docs, table(spark, sf_dir, "labels"))
    return toxicity.judged(toxicity.toxicity_scores(docs, model), 5, 0)


@query
def op5_benchmark_decontamination(spark, sf_dir):
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op2_sentencepiece_sampling(spark, sf_dir):
    return sentencepiece_sampling.encoded(table(spark, sf_dir, "documents"))


@query
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)


@query
def op9_token_files(spark, sf_dir):
    return token_files.round_trip(table(spark, sf_dir, "documents"))


@query
def op4_quality_rules(spark, sf_dir):
    trains = toxicity.fold(F.col("doc_id"), 3) != 1
    return quality_rules.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), trains)


@query
def op7_quality_classifier(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality_classifier.trained(docs, labels, toxicity.fold(F.col("doc_id"), 3) != 1)
    return toxicity.judged(quality_classifier.quality_scores(docs, model), 3, 1)


@query
def op6_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


@query
def op8_warc_derivatives(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages"))


@query
def op13_periodic_runs(spark, sf_dir):
    return periodic_runs.digest(periodic_runs.periodic_runs(periodic_runs.with_loops(table(spark, sf_dir, "documents"))))


@query
def op12_conversation_trie(spark, sf_dir):
    return conversation_trie.prefix_trie(*conversation_trie.rebuilt(table(spark, sf_dir, "conversations")))


ORACLES["op12_conversation_trie"] = r"""
WITH said AS (
  SELECT conv_id, turn, sha256(concat_ws(':', length(coalesce(role, '')), coalesce(role, '') || coalesce(text, ''))) AS s,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words FROM conversations WHERE conv_id IS NOT NULL
), turns AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, s) - 1 AS i FROM said
), steps AS (
  SELECT conv_id, list_concat([4294967295], flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
    lambda x: list_concat([CAST(ascii(x) AS BIGINT)], [-1, -1, -1, -1, -1, -1, -1, -1])))) AS l
  FROM (SELECT DISTINCT conv_id FROM turns)
), ids AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, xor(4294967295, list_reduce(l, lambda a, x: CASE WHEN x >= 0 THEN xor(a, x)
    WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) % 4 AS h FROM steps
), known AS (SELECT conv_id AS base, count(*) AS n FROM turns GROUP BY conv_id
), rebuilt AS (
  SELECT t.conv_id, least(d.h, coalesce(k.n, 0)) + t.i - d.h + 1 AS d, t.s, t.words
  FROM turns t JOIN ids d ON t.conv_id = d.conv_id LEFT JOIN known k ON k.base = d.base WHERE t.i >= d.h
  UNION ALL SELECT d.conv_id, t.i + 1, t.s, t.words FROM ids d JOIN turns t ON t.conv_id = d.base WHERE t.i < d.h
), starts AS (
  SELECT conv_id, d, words, list(s) OVER (PARTITION BY conv_id ORDER BY d) AS p FROM rebuilt
  UNION ALL SELECT conv_id, 0, 0, []::VARCHAR[] FROM ids
), nodes AS (SELECT p, min(conv_id) AS conv_id, len(p) AS depth, count(*) AS n_convs, min(words) AS words FROM starts GROUP BY p
), kids AS (SELECT p[1:depth - 1] AS p, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL
), own AS (
  SELECT o.*, coalesce(k.n, 0) AS n_children, (o.n_convs - 1) * o.words AS saved FROM nodes o LEFT JOIN kids k ON o.p = k.p
), ways AS (SELECT p[1:j] AS p, n_children, saved FROM (SELECT p, n_children, saved, unnest(range(0, depth + 1)) AS j FROM own)
), below AS (SELECT p, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens FROM ways GROUP BY p
), ends AS (
  SELECT p, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS members FROM (
    SELECT conv_id, arg_max(p, d) AS p FROM starts GROUP BY conv_id) GROUP BY p
)
SELECT o.conv_id, CAST(o.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, o.n_convs, CAST(o.n_children AS BIGINT) AS n_children,
  CAST(b.n_leaves AS BIGINT) AS n_leaves, CAST(b.saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(e.members, '')) AS ends_sha256
FROM own o JOIN below b ON o.p = b.p LEFT JOIN ends e ON o.p = e.p LEFT JOIN nodes u ON o.depth > 0 AND u.p = o.p[1:o.depth - 1]
"""


@query
def op11_html_extraction(spark, sf_dir):
    return html_extraction.main_texts(table(spark, sf_dir, "pages"))
