"""DuckDB SQL that computes the same rows as the registered queries from the same tables."""

from __future__ import annotations

from vulnatlas.functions.stemming import STEP_2, STEP_3, STEP_4

ID = "'CVE-' || CAST(1999 + d.doc_id % 26 AS VARCHAR) || '-' || lpad(CAST(d.doc_id AS VARCHAR), 5, '0')"
PUBLISHED = (
    "CAST(1999 + d.doc_id % 26 AS VARCHAR) || '-' || lpad(CAST(1 + d.doc_id % 12 AS VARCHAR), 2, '0') || '-01T00:00:00.000'"
)
CVES = f"""cves AS (
  SELECT {ID} AS id, {PUBLISHED} AS published,
    CASE d.doc_id % 6 WHEN 0 THEN 'CRITICAL' WHEN 1 THEN 'HIGH' WHEN 2 THEN 'MEDIUM' WHEN 3 THEN 'LOW' WHEN 4 THEN 'HIGH' END AS severity,
    CASE WHEN l.doc_id IS NOT NULL THEN CAST((d.doc_id * 37) % 101 AS DOUBLE) / CAST(10 AS DOUBLE) END AS cvss,
    CASE WHEN d.doc_id % 7 <> 0 THEN 'CWE-' || CAST(70 + d.doc_id % 20 AS VARCHAR) END AS cwe,
    d.text AS description, d.source AS source, d.lang AS status
  FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id)"""
RAW = """raw AS (
  SELECT event_id AS id, 'exploits/' || event_type || '/' || CAST(event_id AS VARCHAR) || '.txt' AS file,
    event_type || ' by user ' || CAST(user_id AS VARCHAR) || ': ' || props AS description,
    CAST(CAST(ts AS DATE) AS VARCHAR) AS date, 'user' || CAST(user_id AS VARCHAR) AS author, event_type AS type,
    CASE user_id % 4 WHEN 0 THEN 'linux' WHEN 1 THEN 'windows' WHEN 2 THEN 'php' ELSE 'multiple' END AS platform,
    value >= CAST(5 AS DOUBLE) AS verified,
    CASE WHEN event_id % 5 <> 0 THEN 'CVE-' || CAST(1999 + (user_id % 200) % 26 AS VARCHAR) || '-' || lpad(CAST(user_id % 200 AS VARCHAR), 5, '0') END AS cve
  FROM events WHERE event_id <> 0)"""
SLUG = (
    "rtrim(substring(lower(trim(regexp_replace({0}, '[^a-zA-Z0-9]+', '-', 'g'), '-')), 1, 80), '-')"
)
EXPLOITS = f"""{RAW}, exploits AS (
  SELECT id, description, date, author, type, platform, CAST(NULL AS VARCHAR) AS port, verified,
    coalesce(cve, '') AS cves, type || CASE WHEN verified THEN ',verified' ELSE '' END AS tags,
    'data/writeups/exploitdb/' || CAST(id AS VARCHAR) || '-' || {SLUG.format('description')} || '.md' AS markdown,
    'data/raw/exploitdb/files/' || CAST(id AS VARCHAR) || '.txt' AS source,
    'https://www.exploit-db.com/exploits/' || CAST(id AS VARCHAR) AS url, cve, file
  FROM raw)"""
EXPLOIT_COLUMNS = "id, description, date, author, type, platform, port, verified, cves, tags, markdown, source, url"
WORDS = "regexp_extract_all(lower(strip_accents({0})), '[\\p{{L}}\\p{{N}}]+')"
TOKENS = f"""tokens AS (
  SELECT id, 'description' AS field, {WORDS.format('description')} AS words FROM cves
  UNION ALL SELECT id, 'id', {WORDS.format('id')} FROM cves),
occurrences AS (
  SELECT id, field, unnest(words) AS token, generate_subscripts(words, 1) - 1 AS pos FROM tokens)"""
SEARCH = f"WITH {CVES}, {TOKENS}"
WRITEUPS = """files AS (
  SELECT d.source || '/' || d.lang AS repo,
    d.source || '/' || d.lang || '/' || CAST(d.doc_id AS VARCHAR)
      || CASE d.lang WHEN 'en' THEN '.MD' WHEN 'fr' THEN '.txt' ELSE '.tar.json' END AS path,
    CASE d.lang WHEN 'en' THEN '.md' WHEN 'fr' THEN '.txt' ELSE '.json' END AS ext,
    d.doc_id % 2 = 0 AS heading, d.n_chars AS size,
    coalesce(list_filter(list_transform(string_split(d.text, chr(10)), lambda x: trim(x)), lambda x: x <> '')[1], '') AS line
  FROM documents d WHERE d.lang <> 'de'),
writeups AS (
  SELECT 'data/writeups/' || path AS path,
    CASE WHEN heading THEN line WHEN line LIKE '# %' THEN trim(substring(line, 3)) ELSE substring(line, 1, 120) END AS title,
    repo, size, ext FROM files)"""
# The heading of every second file is '#  ' before the text, so its title is the text's first
# line; a text that starts with an empty line would leave a bare '#'.
FEED = f"""feed AS (
  SELECT {ID} AS id, {PUBLISHED} AS published,
    CASE d.lang WHEN 'de' THEN 'HIGH' WHEN 'en' THEN 'LOW' WHEN 'fr' THEN 'MEDIUM' END AS severity,
    CASE d.lang WHEN 'en' THEN CAST(d.n_chars % 101 AS DOUBLE) / CAST(10 AS DOUBLE) WHEN 'fr' THEN CAST(5 AS DOUBLE) END AS cvss,
    CASE d.lang WHEN 'de' THEN 'AV:N/4' WHEN 'en' THEN 'AV:N/3' WHEN 'fr' THEN 'AV:N/2' END AS cvss_vector,
    CASE WHEN d.lang <> 'fr' THEN 'CWE-' || CAST(70 + d.n_chars % 20 AS VARCHAR) END AS cwe,
    CASE WHEN d.lang = 'en' THEN d.text ELSE '' END AS description, d.text AS text,
    'https://example.org/' || d.source || ',,https://example.org/' || d.lang AS refs,
    d.lang || ',Patch,' || d.source AS ref_tags, d.source AS source, 'Analyzed' AS status,
    CAST(1999 + d.doc_id % 26 AS INTEGER) AS year, d.lang AS lang, d.doc_id AS doc_id
  FROM documents d)"""
# Suffix stripping step by step over the distinct tokens, from the published tables.
C, V = "[^aeiou][^aeiouy]*", "[aeiouy][aeiou]*"
M0, M1 = f"^({C})?{V}{C}", f"^({C})?{V}{C}{V}{C}"
M_EQ_1, VOWEL = f"^({C})?{V}{C}({V})?$", f"^({C})?[aeiouy]"
CVC = f"^{C}[aeiouy][b-df-hj-np-tvz0-9]$"


def less(n: int) -> str:
    return f"left(w, length(w) - {n})"


def has(value: str, pattern: str) -> str:
    return f"regexp_matches({value}, '{pattern}')"


def suffix_step(rules: dict[str, str], measure: str) -> str:
    suffix = f"regexp_extract(w, '({'|'.join(rules)})$', 1)"
    stem = f"left(w, length(w) - length({suffix}))"
    pairs = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in rules.items())
    ion = f"({suffix} <> 'ion' OR {has(stem, '[st]$')})"
    return f"CASE WHEN {suffix} <> '' AND {has(stem, measure)} AND {ion} THEN {stem} || CASE {suffix} {pairs} END ELSE w END"


STEM_STEPS = (
    "CASE WHEN token LIKE 'y%' THEN 'Y' || substring(token, 2) ELSE token END",
    f"CASE WHEN w LIKE '%_sses' OR w LIKE '%_ies' THEN {less(2)} WHEN w LIKE '%s' AND w NOT LIKE '%ss' THEN {less(1)} ELSE w END",
    f"CASE WHEN w LIKE '%_eed' THEN CASE WHEN {has(less(3), M0)} THEN {less(1)} ELSE w END "
    f"WHEN w LIKE '%ed' AND {has(less(2), VOWEL)} THEN {less(2)} || '|' "
    f"WHEN w LIKE '%ing' AND {has(less(3), VOWEL)} THEN {less(3)} || '|' ELSE w END",
    f"CASE WHEN w NOT LIKE '%|' THEN w WHEN {has('w', '(at|bl|iz)[|]$')} THEN {less(1)} || 'e' "
    f"WHEN length(w) > 2 AND lower(w[-2]) = lower(w[-3]) AND {has('w', '[b-df-km-np-rtv-yY0-9][|]$')} THEN {less(2)} "
    f"WHEN {has(less(1), CVC)} THEN {less(1)} || 'e' ELSE {less(1)} END",
    f"CASE WHEN w LIKE '%y' AND {has(less(1), VOWEL)} THEN {less(1)} || 'i' ELSE w END",
    suffix_step(STEP_2, M0),
    suffix_step(STEP_3, M0),
    suffix_step(STEP_4, M1),
    f"CASE WHEN w LIKE '%e' AND ({has(less(1), M1)} OR {has(less(1), M_EQ_1)} AND NOT {has(less(1), CVC)}) THEN {less(1)} ELSE w END",
    f"CASE WHEN w LIKE '%ll' AND {has(less(1), M1)} THEN {less(1)} ELSE w END",
)
STEMS = ", ".join(
    f"s{i} AS (SELECT token, {step} AS w FROM {f's{i - 1}' if i else '(SELECT DISTINCT token FROM occurrences)'})"
    for i, step in enumerate(STEM_STEPS)
) + f""", stemmed AS (SELECT id, field, pos, CASE WHEN strlen(o.token) BETWEEN 3 AND 64 THEN lower(s.w) ELSE o.token END AS token
  FROM occurrences o JOIN s{len(STEM_STEPS) - 1} s ON o.token = s.token)"""
RESULT = "id, published, severity, cvss, cwe, description"

DIFFS = """base AS (
  SELECT doc_id AS id, source || '/' || lang || '.c' AS file, doc_id % 50 + 1 AS o, doc_id % 70 + 2 AS n, lang, source,
    replace(left(text, 30), chr(10), ' ') AS start FROM documents),
diffs AS (
  SELECT id, file, 1 AS hunk, 'context' AS side, o AS old_line, n AS new_line, lang AS line FROM base
  UNION ALL SELECT id, file, 1, 'removed', o + 1, NULL, '-- ' || source FROM base
  UNION ALL SELECT id, file, 1, 'added', NULL, n + 1, '++ ' || source FROM base
  UNION ALL SELECT id, file, 1, 'context', o + 2, n + 2, start FROM base
  UNION ALL SELECT id, file, 1, 'context', o + 3, n + 3, '' FROM base
  UNION ALL SELECT id, file, 2, 'removed', 200, NULL, lang FROM base
  UNION ALL SELECT id, file, 2, 'added', NULL, 300, source FROM base
  UNION ALL SELECT id, file, 2, 'added', NULL, 301, upper(source) FROM base)"""

ORACLES: dict[str, str] = {
    # --- normalisation
    "advisories": f"WITH {CVES} SELECT * FROM cves",
    "normalize_advisories": f"""WITH {FEED}
        SELECT id, published, severity, cvss, cwe, description, refs, ref_tags, source, status, cvss_vector,
          published AS last_modified, year FROM feed""",
    "metric_precedence": f"WITH {FEED} SELECT id, cvss, severity FROM feed",
    "first_cwe": f"WITH {FEED} SELECT id, cwe FROM feed",
    "exploits_base": f"WITH {EXPLOITS} SELECT {EXPLOIT_COLUMNS} FROM exploits",
    "exploit_ids": f"WITH {EXPLOITS} SELECT id, verified, markdown, source, url FROM exploits",
    "exploit_cards": f"""WITH {EXPLOITS} SELECT id, markdown,
        '# ' || CAST(id AS VARCHAR) || ' - ' || description || chr(10) || chr(10)
        || '- **Exploit-DB ID:** ' || CAST(id AS VARCHAR) || chr(10)
        || '- **Date:** ' || date || chr(10)
        || '- **Author:** ' || author || chr(10)
        || '- **Type:** ' || type || '  |  **Platform:** ' || platform || '  |  **Port:** None' || chr(10)
        || '- **Verified:** ' || CASE WHEN verified THEN '1' ELSE '0' END || chr(10)
        || '- **Tags:** ' || type || '; ;' || CASE WHEN verified THEN 'verified' ELSE '' END || chr(10)
        || '- **CVE(s):** ' || coalesce(cve, '') || chr(10)
        || '- **Local PoC file:** `' || source || '`' || chr(10) || chr(10)
        || '## Description' || chr(10) || description || chr(10) || chr(10)
        || '## Source' || chr(10)
        || '- Exploit-DB: ' || url || chr(10)
        || '- Raw file: https://gitlab.com/exploit-database/exploitdb/-/raw/main/' || file || chr(10) AS markdown_body
        FROM exploits""",
    "split_codes_counts": f"""WITH {EXPLOITS}
        SELECT CAST(CASE WHEN cve IS NULL THEN 0 ELSE 1 END AS INTEGER) AS codes, count(*) AS n FROM exploits GROUP BY ALL""",
    "tags_split": f"WITH {EXPLOITS} SELECT id, tags FROM exploits",
    "writeup_index": f"WITH {WRITEUPS} SELECT * FROM writeups",
    "doc_title": """WITH lines AS (
          SELECT doc_id, coalesce(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> '')[1], '') AS line
          FROM documents)
        SELECT doc_id, CASE WHEN line LIKE '# %' THEN trim(substring(line, 3)) ELSE substring(line, 1, 120) END AS title FROM lines""",
    "doc_slug": f"SELECT doc_id, {SLUG.format('text')} AS slug FROM documents",
    "page_basename": "SELECT page_id, string_split(url, '/')[-1] AS basename FROM pages",
    "json_field": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
    "first_assistant": """SELECT conv_id, coalesce(arg_min(text, turn) FILTER (role = 'assistant'), '') AS text
        FROM conversations GROUP BY conv_id""",
    "ref_tags": """SELECT conv_id, string_agg(role, ',' ORDER BY turn, role) AS roles
        FROM (SELECT conv_id, role, min(turn) AS turn FROM conversations GROUP BY conv_id, role) GROUP BY conv_id""",
    # --- search
    "token_counts": f"WITH {CVES} SELECT id, CAST(len({WORDS.format('description')}) AS INTEGER) AS n_tokens FROM cves",
    "postings": f"""{SEARCH} SELECT id, field, token, CAST(count(*) AS INTEGER) AS n, string_agg(CAST(pos AS VARCHAR), ',' ORDER BY pos) AS positions
        FROM occurrences GROUP BY id, field, token""",
    "postings_index": f"""{SEARCH} SELECT token, field, count(DISTINCT id) AS documents, count(*) AS occurrences
        FROM occurrences GROUP BY token, field""",
    "match_all": f"""{SEARCH} SELECT id FROM occurrences WHERE token IN ('the', 'with', 'from')
        GROUP BY id HAVING count(DISTINCT token) = 3""",
    "match_any": f"{SEARCH} SELECT DISTINCT id FROM occurrences WHERE token IN ('vivi', 'ouing', 'quequ')",
    "match_none": f"""{SEARCH} SELECT id FROM cves c WHERE NOT EXISTS (
        SELECT 1 FROM occurrences o WHERE o.id = c.id AND o.token IN ('the', 'que'))""",
    "match_prefix": f"{SEARCH} SELECT DISTINCT id FROM occurrences WHERE starts_with(token, 'ingre')",
    "match_phrase": f"""{SEARCH} SELECT DISTINCT a.id FROM occurrences a JOIN occurrences b
        ON a.id = b.id AND a.field = b.field AND b.pos = a.pos + 1 WHERE a.token = 'of' AND b.token = 'the'""",
    "match_near": f"""{SEARCH} SELECT DISTINCT a.id FROM occurrences a JOIN occurrences b
        ON a.id = b.id AND a.field = b.field AND abs(b.pos - a.pos) <= 4 WHERE a.token = 'and' AND b.token = 'the'""",
    "match_first": f"{SEARCH} SELECT DISTINCT id FROM occurrences WHERE token = 'the' AND pos = 0",
    "match_field": f"{SEARCH} SELECT DISTINCT id FROM occurrences WHERE token = '2024' AND field = 'id'",
    "search_filtered": f"""WITH {CVES} SELECT {RESULT} FROM cves
        WHERE list_contains({WORDS.format('description')}, 'the') AND severity IN ('CRITICAL', 'HIGH')
          AND substring(published, 1, 4) >= '2005' AND cvss >= 3.0
        ORDER BY cvss DESC NULLS LAST, id LIMIT 50""",
    "search_all_filters": f"""{SEARCH}, phrase AS (
          SELECT DISTINCT a.id FROM occurrences a JOIN occurrences b
          ON a.id = b.id AND a.field = b.field AND b.pos = a.pos + 1 WHERE a.token = 'of' AND b.token = 'the')
        SELECT {RESULT} FROM cves WHERE id IN (FROM phrase)
          AND id IN (SELECT id FROM occurrences WHERE token = 'and')
          AND severity IN ('HIGH', 'MEDIUM', 'LOW') AND cwe LIKE '%CWE-8%' AND substring(published, 1, 4) >= '2000'""",
    "merge_segments": f"""{SEARCH} SELECT token, count(*) AS n FROM (SELECT DISTINCT id, field, token FROM occurrences) GROUP BY token""",
    "prefix_search": f"""{SEARCH} SELECT {RESULT} FROM cves WHERE id IN (SELECT id FROM occurrences WHERE starts_with(token, 'ingre'))
        AND severity = 'HIGH' AND substring(published, 1, 4) >= '2005' ORDER BY cvss DESC NULLS LAST, id LIMIT 30""",
    "search_or_not": f"""{SEARCH}, held AS (SELECT id, list(DISTINCT token) AS t FROM occurrences GROUP BY id)
        SELECT {RESULT} FROM cves JOIN held USING (id) WHERE (list_has_any(t, ['vivi', 'ouing']) OR list_has_all(t, ['the', 'from']))
          AND NOT list_contains(t, 'with') AND cvss >= 2.0 ORDER BY cvss DESC NULLS LAST, id LIMIT 40""",
    "search_prefix_filtered": f"""{SEARCH}, {STEMS}, open_end AS (
          SELECT a.id FROM stemmed a JOIN stemmed b ON a.id = b.id AND a.field = b.field AND b.pos = a.pos + 1
          WHERE a.token = 'of' AND starts_with(b.token, 'th'))
        SELECT {RESULT} FROM cves WHERE severity = 'CRITICAL' AND substring(published, 1, 4) >= '2003' AND (
          id IN (FROM open_end) AND id IN (SELECT id FROM stemmed WHERE token = 'reat')
          OR id IN (SELECT id FROM stemmed WHERE field = 'description' AND token = 'of' AND pos = 0))""",
    "near_phrases": f"""{SEARCH}, starts AS (
          SELECT a.id, a.pos, 'of the' AS phrase, 2 AS n FROM occurrences a JOIN occurrences b
            ON a.id = b.id AND a.field = b.field AND b.pos = a.pos + 1 WHERE a.token = 'of' AND b.token = 'the' AND a.field = 'description'
          UNION ALL SELECT id, pos, token, 1 FROM occurrences WHERE token IN ('and', 'to') AND field = 'description')
        SELECT DISTINCT id FROM (SELECT m.id, m.pos FROM starts m JOIN starts s ON m.id = s.id AND s.pos BETWEEN m.pos - s.n - 4 AND m.pos
          GROUP BY m.id, m.pos HAVING count(DISTINCT s.phrase) = 3)""",
    "search_top_scored": f"""{SEARCH} SELECT {RESULT} FROM cves WHERE id IN (SELECT id FROM occurrences WHERE token = 'the')
        ORDER BY cvss DESC NULLS LAST, id LIMIT 25""",
    "substring_search": f"""WITH {CVES} SELECT {RESULT} FROM cves WHERE contains(lower(description), 'ion the') AND severity = 'HIGH'""",
    "stemmed_search": f"""{SEARCH}, {STEMS} SELECT {RESULT} FROM cves
        WHERE id IN (SELECT id FROM stemmed WHERE token = 'tion') AND id IN (SELECT id FROM stemmed WHERE token = 'reat')""",
    "stemmed_postings": f"""{SEARCH}, {STEMS} SELECT token, count(DISTINCT id || field) AS fields, count(*) AS occurrences
        FROM stemmed GROUP BY token""",
    "product_search": f"""WITH {CVES} SELECT {RESULT} FROM cves
        WHERE lower(description) LIKE '%tion%' AND substring(published, 1, 4) >= '2010' AND severity = 'HIGH'
          AND cwe IN ('CWE-73', 'CWE-81') ORDER BY cvss DESC NULLS LAST, id LIMIT 40""",
    "lookup_cve": f"""WITH {CVES} SELECT id, published, severity, cvss, cwe, description, source AS "references",
        status AS "refTags", source, status FROM cves WHERE id = 'CVE-2006-00007'""",
    "lookup_exploits": f"""WITH {EXPLOITS} SELECT cve AS cve_id, 0 AS block, id AS exploitdb_id, description, type,
        platform, markdown, url FROM exploits WHERE cve = 'CVE-2006-00007'""",
    "cwe_exact": f"WITH {CVES} SELECT id, cwe FROM cves WHERE cwe IN ('CWE-75', 'CWE-8')",
    "cwe_substring": f"WITH {CVES} SELECT id, cwe FROM cves WHERE cwe LIKE '%CWE-75%' OR cwe LIKE '%CWE-8%'",
    "exploit_search": f"""WITH {EXPLOITS} SELECT id, description, type, platform, cves, markdown, url FROM exploits
        WHERE lower(description) LIKE '%purchase%' AND lower(platform) LIKE '%lin%' ORDER BY id LIMIT 100""",
    "exploits_on_platform": f"""WITH {EXPLOITS} SELECT id, description, type, platform, cves, markdown, url FROM exploits
        WHERE platform LIKE '%php%'""",
    "writeup_search": f"""WITH {WRITEUPS} SELECT path, title, repo, size FROM writeups
        WHERE contains(lower(title), 'th') OR contains(lower(path), 'th') OR contains(lower(repo), 'th')""",
    "page_writeups": """SELECT url AS path, CAST(length(html) AS INTEGER) AS size FROM pages
        WHERE contains(lower(url), 'spam-farm') OR contains(lower(html), 'spam-farm')""",
    "sql_join": f"""WITH {CVES} SELECT id, severity, cvss, cwe, description FROM cves
        WHERE list_contains({WORDS.format('description')}, 'with') ORDER BY cvss DESC NULLS LAST, id LIMIT 20""",
    # --- links
    "exploit_cve_map": f"WITH {EXPLOITS} SELECT id AS exploit_id, cves FROM exploits WHERE cve IS NOT NULL",
    "cve_exploits": f"""WITH {CVES}, {EXPLOITS} SELECT c.id AS cve_id, c.severity, c.cvss, e.id AS exploit_id, e.type, e.platform
        FROM cves c JOIN exploits e ON e.cve = c.id""",
    "cve_with_exploits": f"""WITH {CVES}, {EXPLOITS} SELECT c.id, c.severity, e.id // 1000 AS block,
        CAST(count(e.id) AS INTEGER) AS n, string_agg(CAST(e.id AS VARCHAR), ',' ORDER BY e.id) AS exploit_ids
        FROM cves c LEFT JOIN exploits e ON e.cve = c.id GROUP BY ALL""",
    "stored_lookup": f"""WITH {CVES}, {EXPLOITS} SELECT cve AS cve_id, e.id AS exploitdb_id, e.description, type, platform, markdown, url
        FROM exploits e JOIN cves c ON c.id = e.cve WHERE cve = 'CVE-2006-00007'""",
    "exploit_counts": f"""WITH {CVES}, {EXPLOITS} SELECT c.id, count(e.id) AS n FROM cves c LEFT JOIN exploits e ON e.cve = c.id
        GROUP BY c.id""",
    "coverage_gap": """SELECT d.doc_id AS id, d.lang, d.source FROM documents d
        WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
    "missing_files": """SELECT DISTINCT url AS file FROM pages p WHERE NOT EXISTS (
        SELECT 1 FROM documents d WHERE CAST(d.doc_id AS VARCHAR) = string_split(p.url, '/')[-1])""",
    # --- summaries
    "table_counts": "SELECT 'cves' AS \"table\", count(*) AS n FROM documents UNION ALL SELECT 'exploits', count(*) FROM events WHERE event_id <> 0",
    "severity_counts": f"WITH {CVES} SELECT severity, count(*) AS n FROM cves GROUP BY severity",
    "top_cwe": f"""WITH {CVES} SELECT cwe, count(*) AS n FROM cves WHERE cwe IS NOT NULL
        GROUP BY cwe ORDER BY n DESC, cwe LIMIT 10""",
    "top_scored": f"""WITH {CVES} SELECT id, cvss, substring(description, 1, 60) AS description FROM cves
        ORDER BY cvss DESC NULLS LAST, id LIMIT 5""",
    "year_counts": f"""WITH {CVES}, y AS (SELECT substring(published, 1, 4) AS year, count(*) AS n FROM cves GROUP BY 1)
        SELECT year, n, CAST(sum(n) OVER (ORDER BY year) AS BIGINT) AS cumulative FROM y""",
    "stats": f"""WITH {CVES}, {WRITEUPS}
        SELECT 'rows' AS section, 'cves' AS item, count(*) AS n FROM cves
        UNION ALL SELECT 'rows', 'exploits', count(*) FROM events WHERE event_id <> 0
        UNION ALL SELECT 'rows', 'writeups', count(*) FROM writeups
        UNION ALL SELECT 'by_severity', severity, count(*) FROM cves GROUP BY severity
        UNION ALL (SELECT 'top_cwe', cwe, count(*) AS n FROM cves WHERE cwe IS NOT NULL GROUP BY cwe ORDER BY n DESC, cwe LIMIT 10)
        UNION ALL (SELECT 'top_scored', substring(description, 1, 60), NULL FROM cves ORDER BY cvss DESC NULLS LAST, id LIMIT 5)
        UNION ALL SELECT 'enrichment_tables', 'hf_vuln_patches', NULL
        UNION ALL SELECT 'enrichment_tables', 'hf_vuln_scores', NULL""",
    "kept_summaries": f"""WITH {CVES}, y AS (SELECT substring(published, 1, 4) AS year, count(*) AS n FROM cves GROUP BY 1)
        SELECT 'by_severity' AS section, severity AS item, count(*) AS n FROM cves GROUP BY severity
        UNION ALL (SELECT 'top_cwe', cwe, count(*) AS n FROM cves WHERE cwe IS NOT NULL GROUP BY cwe ORDER BY n DESC, cwe LIMIT 10)
        UNION ALL SELECT 'by_year', year, n FROM y""",
    # --- enrichment
    "any_table_search": """SELECT * FROM (
          SELECT 'hf_benchmark' AS "table", CAST(item_id AS VARCHAR) AS id, text AS description, NULL AS title,
            NULL AS page_id, NULL AS url, NULL AS html
          FROM benchmark WHERE contains(lower(text), 'ingre') ORDER BY id, description LIMIT 7)
        UNION ALL SELECT * FROM (
          SELECT 'hf_documents', CAST(doc_id AS VARCHAR) AS id, text, source, NULL, NULL, NULL FROM documents
          WHERE contains(lower(text), 'ingre') OR contains(lower(source), 'ingre') ORDER BY id, source, text LIMIT 7)
        UNION ALL SELECT * FROM (
          SELECT 'hf_pages', NULL, NULL, NULL, CAST(page_id AS VARCHAR) AS page_id, url, html FROM pages
          WHERE contains(lower(url), 'ingre') OR contains(lower(html), 'ingre') ORDER BY page_id LIMIT 7)""",
    "match_counts": """SELECT 'hf_benchmark' AS "table", count(*) AS n FROM benchmark WHERE contains(lower(text), 'with') HAVING count(*) > 0
        UNION ALL SELECT 'hf_documents', count(*) FROM documents WHERE contains(lower(text), 'with') HAVING count(*) > 0
        UNION ALL SELECT 'hf_pages', count(*) FROM pages WHERE contains(lower(html), 'with') OR contains(lower(url), 'with') HAVING count(*) > 0""",
    "patch_search": f"""WITH p AS (
          SELECT {ID} AS id, d.source AS title, '["CWE-' || CAST(70 + d.doc_id % 20 AS VARCHAR) || '"]' AS cwe,
            d.doc_id, to_base64(encode(d.text)) AS patch FROM documents d)
        SELECT id, title, cwe FROM p WHERE contains(lower(title), 'src1') OR contains(lower(patch), 'src1')
        ORDER BY id, title LIMIT 25""",
    "decoded_patch_search": f"""SELECT {ID} AS id, d.source AS title, 'CWE-' || CAST(70 + d.doc_id % 20 AS VARCHAR) AS cwe,
        CAST(0 AS INTEGER) AS n, 'https://example.org/' || CAST(d.doc_id AS VARCHAR) AS url,
        decode(from_base64(to_base64(encode(d.text)))) AS diff
        FROM documents d WHERE contains(lower(d.text), 'of the')""",
    "b64_roundtrip": f"""SELECT {ID} AS id, CAST(0 AS INTEGER) AS n, decode(from_base64(to_base64(encode(d.text)))) AS diff FROM documents d
        UNION ALL SELECT {ID}, 1, NULL FROM documents d""",
    "patch_lines": f"WITH {DIFFS} SELECT * FROM diffs",
    "changed_lines": f"WITH {DIFFS} SELECT * FROM diffs WHERE side = 'added' AND contains(lower(line), 'src1') AND contains(file, '/en')",
    "text_compat": f"""WITH {EXPLOITS} SELECT CAST(id AS VARCHAR) AS id, description, date, author, type, platform, port,
        CASE WHEN verified THEN 'true' ELSE 'false' END AS verified,
        CASE WHEN cve IS NULL THEN '[]' ELSE '["' || cve || '"]' END AS cves,
        '["' || replace(tags, ',', '","') || '"]' AS tags, markdown, source, url FROM exploits""",
    "json_text_arrays": f"WITH {EXPLOITS} SELECT id, cves, tags FROM exploits",
    "lenient_json": """SELECT event_id, CASE WHEN event_type = 'click' THEN event_type ELSE props END AS patches,
        CASE WHEN event_type <> 'click' THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k FROM events""",
    "ndjson_rows": f"""WITH {CVES} SELECT '{{"id":"' || id || '","published":"' || published || '","severity":'
        || coalesce('"' || severity || '"', 'null') || ',"cwe":' || coalesce('"' || cwe || '"', 'null')
        || ',"source":"' || source || '"}}' AS line FROM cves""",
    "shard_union": "SELECT * FROM documents UNION ALL BY NAME SELECT * FROM benchmark",
    "any_jsonl": "SELECT * FROM documents UNION ALL BY NAME SELECT * FROM benchmark",
    "enrichment_datasets": """SELECT 'hf_documents: doc_id,lang,n_chars,source,text' AS "table", count(*) AS n FROM documents
        UNION ALL SELECT 'hf_labels: doc_id,quality,toxic', count(*) FROM labels""",
    "provenance": """SELECT 'own/' || t AS dataset, 'parquet' AS mode, 'default' AS config, 'train' AS split, n AS rows, 'hf_' || t AS "table"
        FROM (SELECT 'documents' AS t, count(*) AS n FROM documents UNION ALL SELECT 'labels', count(*) FROM labels
              UNION ALL SELECT 'pages', count(*) FROM pages)""",
    "enrichment_build": """SELECT 'own: doc_id,quality,toxic' AS "table", count(*) AS n FROM labels
        UNION ALL SELECT 'own__new: item_id,text', count(*) FROM benchmark
        UNION ALL SELECT 'own__old: event_id,event_type,props,ts,user_id,value', count(*) FROM events""",
    # --- landing, merging and publishing
    "feeds_then_search": f"""WITH {FEED}, worded AS (SELECT *, {WORDS.format('description')} AS w FROM feed)
        SELECT {RESULT} FROM worded WHERE list_contains(w, 'the') AND len(list_filter(w, lambda x: starts_with(x, 'ingre'))) > 0
          AND year >= 2001 ORDER BY cvss DESC NULLS LAST, id LIMIT 25""",
    "feed_files": f"""WITH {FEED} SELECT id, published, severity, cvss, cwe, description, source, status, year FROM feed""",
    "published_state": f"""WITH {CVES}, {EXPLOITS} SELECT 'cves' AS "table", id, severity AS item FROM cves
        UNION ALL SELECT 'exploits', CAST(id AS VARCHAR), platform FROM exploits""",
    "catalogue_csv": """SELECT CAST(doc_id AS VARCHAR) AS id, text AS description, '"' || lang || '",' || source AS tags,
        '' AS port, CAST(NULL AS VARCHAR) AS codes FROM documents""",
    "jsonl_index": f"""WITH {CVES} SELECT id, published, severity, cvss, cwe, description, source, status,
        CAST(substring(published, 1, 4) AS INTEGER) AS year FROM cves""",
    "document_store": f"""WITH {FEED} SELECT id, CAST(year AS VARCHAR) AS year, text FROM feed WHERE year BETWEEN 2005 AND 2010""",
    "row_budget": f"WITH {FEED} SELECT id FROM feed ORDER BY lang, doc_id LIMIT 100",
    "append_new": f"SELECT {ID} AS id, d.text, d.lang, CASE WHEN d.lang <> 'en' THEN 'first' ELSE 'second' END AS delivery FROM documents d",
    "ingest_stream": f"SELECT {ID} AS id, d.text, d.lang, CASE WHEN d.lang <> 'en' THEN 'first' ELSE 'second' END AS delivery FROM documents d",
    "stream_latest": f"""WITH {CVES} SELECT id, severity, description, CASE WHEN severity <> 'LOW' THEN '2024-01-03' ELSE '2024-01-01' END AS last_modified
        FROM cves""",
    "writeup_files": """SELECT CASE WHEN line LIKE '# %' THEN trim(substring(line, 3)) ELSE substring(line, 1, 120) END AS title, '' AS reason FROM (
          SELECT coalesce(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> '')[1], '') AS line FROM benchmark)
        UNION ALL SELECT '', 'extension'""",
    "dedup_first": """SELECT conv_id, turn, role, text FROM conversations
        QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) = 1""",
    "latest_wins": f"SELECT {ID} AS id, d.text, d.lang, 'second' AS delivery FROM documents d",
    "map_upsert": f"""WITH {EXPLOITS} SELECT id AS exploit_id, CASE WHEN verified THEN 'new:' || tags ELSE cves END AS cves FROM exploits""",
    "duplicate_keys": "SELECT conv_id, count(*) AS n FROM conversations GROUP BY conv_id HAVING count(*) > 1",
    "export_roundtrip": f"WITH {CVES} SELECT * FROM cves",
    "export_parts": f"WITH {CVES} SELECT id, cvss, severity FROM cves",
    "export_counts": """SELECT 'cves' AS "table", count(*) AS n, count(*) AS read_back FROM documents
        UNION ALL SELECT 'exploits', count(*), count(*) FROM events WHERE event_id <> 0""",
}
ORACLES["scan_search"] = ORACLES["append_then_search"] = ORACLES["search_all_filters"]
ORACLES["stream_then_search"] = ORACLES["search_filtered"]
ORACLES["stored_cve_exploits"] = ORACLES["cve_exploits"]
ORACLES["table_upsert"] = ORACLES["map_upsert"]
