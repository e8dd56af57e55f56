"""Tokens, stems and matches against SQLite's full-text index over the same rows."""

from __future__ import annotations

import sqlite3

import pytest
from pyspark.sql import functions as F

from vulnatlas.functions.stemming import stems
from vulnatlas.functions.text import tokens
from vulnatlas.operators import matching
from vulnatlas.operators.postings import build_postings, query_tokens, write_postings
from vulnatlas.plans import queries

TEXTS = {
    "CVE-2021-44228": "Apache Log4j2 JNDI features do not protect against attacker controlled LDAP",
    "CVE-2021-45046": "The fix for Apache Log4j 2.15.0 was incomplete; log4j_core is vulnerable",
    "CVE-2014-6271": "GNU Bash processes trailing strings after function definitions (Shellshock)",
    "CVE-2019-0211": "In Apache HTTP Server 2.4, code executing in child processes executes arbitrary code",
    "CVE-2024-3400": "A command injection vulnerability; vulnerabilities in the httpd apache module",
    "CVE-2020-0001": "Éclair naïve café  C++ résumés ộ éte дом straße",
    "CVE-2020-0002": "a b a b a c c c a",
    "CVE-2020-0003": "",
    "CVE-2020-0004": None,
}


@pytest.fixture(scope="module")
def cves(spark):
    rows = [(i, t, "HIGH" if n % 2 else "LOW", float(n) if n % 3 else None, f"{i[4:8]}-01-01", f"CWE-{n}")
            for n, (i, t) in enumerate(TEXTS.items())]
    return spark.createDataFrame(rows, "id string, description string, severity string, cvss double, published string, cwe string").cache()


@pytest.fixture(scope="module", params=["built", "stored"])
def index(request, cves, tmp_path_factory):
    built = build_postings(cves, stem=True).cache()
    if request.param == "built":
        return built
    return write_postings(built, str(tmp_path_factory.mktemp("postings") / "p"), partitions=3)


@pytest.fixture(scope="module")
def fts():
    con = sqlite3.connect(":memory:")
    con.execute("CREATE VIRTUAL TABLE f USING fts5(id, description, tokenize='porter unicode61')")
    con.executemany("INSERT INTO f VALUES (?, ?)", [(i, t or "") for i, t in TEXTS.items()])
    return lambda q: sorted(r[0] for r in con.execute("SELECT id FROM f WHERE f MATCH ?", (q,)))


def ids(df):
    found = [r.id for r in df.collect()]
    assert len(found) == len(set(found))
    return sorted(found)


def test_postings_equal_the_fts_vocabulary(index):
    con = sqlite3.connect(":memory:")
    con.execute("CREATE VIRTUAL TABLE f USING fts5(id, description, tokenize='porter unicode61')")
    con.executemany("INSERT INTO f VALUES (?, ?)", [(i, t or "") for i, t in TEXTS.items()])
    con.execute("CREATE VIRTUAL TABLE v USING fts5vocab(f, 'instance')")
    names = list(TEXTS)
    want = sorted((term, names[doc - 1], col, pos) for term, doc, col, pos in con.execute("SELECT term, doc, col, offset FROM v"))
    got = index.select("token", "id", "field", F.explode("positions").alias("pos"))
    assert sorted(map(tuple, got.collect())) == want


@pytest.mark.parametrize("terms", [
    ["apache"], ["apache", "log4j"], ["vulnerable"], ["executing", "codes"], ["2024"], ["CVE-2021-45046"],
    ["httpd apache"], ["apache httpd"], ["log4j_core"], ["C++"], ["éclair"], ["ÉCLAIR", "cafe"], ["naive café"],
    ["b a c"], ["c c c"], ["c c c c"], ["a b a b a c", "a"], ["resume"], ["дом"], ["straße"],
])
def test_terms(spark, index, fts, terms):
    expression = " AND ".join(f'"{term}"' for term in terms)
    assert ids(queries.match_terms(index, terms)) == fts(expression)


def stem(spark, term):
    return query_tokens(spark, [term], stem=True)[0][0]


@pytest.mark.parametrize("prefix", ["log4", "execut", "executing", "vuln", "20"])
def test_prefix(spark, index, fts, prefix):
    assert ids(matching.match_prefix(index, stem(spark, prefix))) == fts(f"{prefix}*")


@pytest.mark.parametrize(("a", "b", "n"), [("apache", "child", 3), ("child", "apache", 2), ("b", "c", 1), ("b", "c", 0), ("a", "c", 10), ("gnu", "apache", 10)])
def test_near(index, fts, a, b, n):
    near = matching.match_near(index, stem(index.sparkSession, a), stem(index.sparkSession, b), n)
    assert ids(near) == fts(f"NEAR({a} {b}, {n})")


def test_boolean_field_and_first(spark, index, cves, fts):
    apache, bash = stem(spark, "apache"), stem(spark, "bash")
    assert ids(matching.match_any(index, [apache, bash])) == fts("apache OR bash")
    hits = matching.match_any(index, [apache])
    assert ids(matching.match_none(hits, index, [stem(spark, "log4j")])) == fts("apache NOT log4j")
    assert ids(matching.match_none(cves, index, [apache])) == sorted(set(TEXTS) - set(fts("apache")))
    assert ids(matching.match_all(index, ["2021"], field="id")) == fts("id : 2021")
    assert ids(matching.match_all(index, ["2021"], field="description")) == fts("description : 2021")
    assert ids(matching.match_first(index, apache)) == fts("^apache")
    assert ids(matching.match_first(index, "a")) == fts("^a")


def test_search_filters_and_order(spark, index, cves):
    found = queries.search(index, cves, "apache", severity="high , low", since=2019).collect()
    assert [r.id for r in found] == ["CVE-2024-3400", "CVE-2021-45046", "CVE-2019-0211", "CVE-2021-44228"]
    assert queries.search(index, cves, ["apache"], min_cvss=2.0, cwe="cwe-4").first().id == "CVE-2024-3400"
    assert queries.search(index, cves, "apache", limit=1).count() == 1
    with pytest.raises(ValueError, match="two characters"):
        queries.search(index, cves, "a")
    with pytest.raises(ValueError, match="without letters"):
        queries.search(index, cves, "+++")


def test_only_gives_the_same_postings(cves):
    for stemmed, wanted in ((False, ["apache", "code", "a"]), (True, ["execut", "vulner", "process", "c"])):
        whole = build_postings(cves, stem=stemmed).filter(F.col("token").isin(wanted))
        some = build_postings(cves, stem=stemmed, only=wanted)
        assert sorted(map(tuple, some.collect())) == sorted(map(tuple, whole.collect())) != []


def fts_stems(words):
    con = sqlite3.connect(":memory:")
    con.execute("CREATE VIRTUAL TABLE f USING fts5(w, tokenize='porter unicode61')")
    con.executemany("INSERT INTO f(rowid, w) VALUES (?, ?)", list(enumerate(words)))
    con.execute("CREATE VIRTUAL TABLE v USING fts5vocab(f, 'instance')")
    return {words[doc]: term for term, doc in con.execute("SELECT term, doc FROM v")}


def test_stems_of_the_vocabulary(spark):
    """Stems of every word of the documents, and of made-up words with every listed suffix."""
    words = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(tokens(F.col("text")).alias("words"))
    bases = ["", "a", "b", "y", "try", "syzyg", "trou", "hop", "fil", "controll", "vietnam", "o", "yy", "electr", "r"]
    suffixes = ["", "s", "es", "ies", "sses", "eed", "ed", "ing", "y", "e", "ll", "ational", "tional", "enci", "anci",
                "izer", "logi", "bli", "alli", "entli", "eli", "ousli", "ization", "ation", "ator", "alism", "iveness",
                "fulness", "ousness", "aliti", "iviti", "biliti", "icate", "ative", "alize", "iciti", "ical", "ful",
                "ness", "ance", "able", "ible", "ement", "sion", "tion", "ion", "ou", "ism", "ate", "iti", "ize"]
    made = [b + x + y for b in bases for x in suffixes for y in ("", "s", "ing", "ed", "ly") if b + x + y] + ["z" * 62 + "ing"]
    words = words.union(spark.createDataFrame([(made,)], "words array<string>"))
    pairs = words.select(F.explode(F.arrays_zip("words", stems("words").alias("stem"))).alias("p")).select("p.*").distinct()
    got = dict(map(tuple, pairs.collect()))
    assert got == fts_stems(list(got))
    assert all(word.startswith(stem[: max(1, len(stem) - 1)]) for word, stem in got.items())


def test_folding_of_latin_letters(spark):
    """Each letter alone as a word, compared with what the index of SQLite makes of it."""
    letters = [chr(c) for c in (*range(0xC0, 0x180), *range(0x1E00, 0x1EFA)) if chr(c).isalpha()]
    rows = spark.createDataFrame([(letter,) for letter in letters], "w string").select("w", tokens(F.col("w")).alias("t"))
    got = {r.w: r.t[0] for r in rows.collect()}
    con = sqlite3.connect(":memory:")
    con.execute("CREATE VIRTUAL TABLE f USING fts5(w, tokenize='unicode61')")
    con.executemany("INSERT INTO f(rowid, w) VALUES (?, ?)", list(enumerate(letters)))
    con.execute("CREATE VIRTUAL TABLE v USING fts5vocab(f, 'instance')")
    want = {letters[doc]: term for term, doc in con.execute("SELECT term, doc FROM v")}
    assert {k: (got[k], v) for k, v in want.items() if got[k] != v} == {}


def test_query_terms_run_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("terms", "terms")
    assert query_tokens(spark, ["Executing_code", "it's"], stem=True) == [["execut", "code"], ["it", "s"]]
    assert not tracker.getJobIdsForGroup("terms")


def test_postings_are_built_without_a_shuffle(cves, plan):
    physical = plan(build_postings(cves, stem=True)).split("== Physical Plan ==")[1]
    assert "Exchange" not in physical.split("InMemoryRelation")[0]


def test_stored_postings_are_pruned_by_token(spark, cves, tmp_path, plan):
    stored = write_postings(build_postings(cves), str(tmp_path / "p"))
    assert "PushedFilters: [In(token, [apache,log4j])" in plan(matching.match_all(stored, ["apache", "log4j"]))
    assert "StringStartsWith(token,log)" in plan(matching.match_prefix(stored, "log"))


def test_phrase_hits_are_among_the_hits_of_all_terms(cves):
    index = build_postings(cves)
    for words in (["apache", "log4j"], ["a", "b"], ["b", "a", "c"], ["the", "httpd"]):
        assert set(ids(matching.match_phrase(index, words))) <= set(ids(matching.match_all(index, words)))


def test_matching_texts_in_place_equals_the_index(cves):
    index = build_postings(cves)
    for terms in ([["apache"]], [["httpd", "apache"]], [["a", "b"], ["c"]], [["code"], ["child"]], [["cafe"]]):
        in_place = cves.filter(matching.text_matches(F.col("description"), terms)).select("id")
        assert ids(in_place) == ids(matching.match_terms(index, terms, field="description"))
