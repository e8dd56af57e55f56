"""Exploit catalogue: CSV scan, normalisation, cards and links."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from vulnatlas.functions import columns as C
from vulnatlas.operators import links
from vulnatlas.operators.normalize import exploit_cards, normalize_exploits
from vulnatlas.plans import queries
from vulnatlas.plans.pipeline import append_exploits, exploit_table
from vulnatlas.sources.exploits import read_catalogue

CSV = '''id,file,description,date_published,author,type,platform,port,date_added,verified,codes,tags
1,exploits/php/1.txt,"Say ""hi"",
twice",2020-01-02,Ann,remote,linux,80,x,0,CVE-2020-1; osvdb-3|cve-2021-2,a; ;b
0,exploits/php/0.txt,zero,,,,,,,,,
abc,exploits/php/x.txt,not a number,,,,,,,,,
,exploits/php/y.txt,empty,,,,,,,,,
2,exploits/win/2.py,Short row
3,exploits/win/3.c,Café -- overflow!!!,2021-01-01,Bob,local,windows,,x,1,,
3,exploits/win/3b.c,copy of three,2021-01-02,Bob,local,windows,,x,1,CVE-2021-2,
'''


@pytest.fixture(scope="module")
def catalogue(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("csv") / "files_exploits.csv"
    path.write_text(CSV, encoding="utf-8")
    return str(path)


def test_scan(spark, catalogue):
    found = {r.file: r for r in read_catalogue(spark, catalogue).collect()}
    assert len(found) == 7
    assert found["exploits/php/1.txt"].description == 'Say "hi",\ntwice'
    short = found["exploits/win/2.py"]
    assert (short.description, short.codes, short.tags) == ("Short row", None, None)
    assert found["exploits/win/3.c"].port == ""
    assert [r.id for r in read_catalogue(spark, catalogue, limit=2).orderBy("source_order").collect()] == ["1", "0"]


def test_normalized_rows(spark, catalogue):
    table = {r.id: r for r in exploit_table(spark, catalogue).collect()}
    assert sorted(table) == [1, 2, 3]
    one = table[1]
    assert one.cves == ["CVE-2020-1", "CVE-2021-2"] and one.tags == ["a", "b"] and one.verified is False
    assert one.markdown == "data/writeups/exploitdb/1-say-hi-twice.md"
    assert one.source == "data/raw/exploitdb/files/1.txt"
    assert one.url == "https://www.exploit-db.com/exploits/1"
    assert (table[2].cves, table[2].tags, table[2].verified) == ([], [], False)
    assert table[3].description.startswith("Café") and table[3].verified is True
    assert table[3].markdown.endswith("/3-caf-overflow.md")


@pytest.mark.parametrize(("text", "slug"), [
    ("--A  b__C--", "a-b-c"), ("", ""), ("!!!", ""), ("x" * 100, "x" * 80), ("a" * 79 + "/b", "a" * 79),
])
def test_slug(spark, text, slug):
    assert spark.range(1).select(C.slug(F.lit(text)).alias("s")).first().s == slug


def test_append_skips_stored_exploits(spark, catalogue, tmp_path):
    path = str(tmp_path / "exploits")
    assert [append_exploits(spark, catalogue, path) for _ in range(2)] == [3, 0]
    stored = spark.read.parquet(path)
    assert "source_order" not in stored.columns
    assert stored.filter("id = 3").first().description.startswith("Café")


def test_card(spark, catalogue):
    body = {r.id: r.markdown_body for r in exploit_cards(read_catalogue(spark, catalogue)).collect()}
    assert body[1].splitlines()[:2] == ['# 1 - Say "hi",', "twice"]
    assert "- **CVE(s):** CVE-2020-1, CVE-2021-2\n" in body[1]
    assert "- **Type:** remote  |  **Platform:** linux  |  **Port:** 80\n" in body[1]
    assert "- **Date:** None\n" in body[2]


def test_links_use_whole_ids(spark, catalogue, rows):
    table = exploit_table(spark, catalogue)
    cves = spark.createDataFrame([("CVE-2021-2", "HIGH"), ("CVE-2021-22", "LOW"), ("CVE-2020-1", None)], "id string, severity string")
    found = links.exploits_of_advisories(cves, table).select("cve_id", "exploit_id")
    assert rows(found) == [("CVE-2020-1", 1), ("CVE-2021-2", 1)]
    nested = {r.id: r for r in links.advisories_with_exploits(cves, table).collect()}
    assert nested["CVE-2021-22"].exploits is None
    assert [e.exploitdb_id for e in nested["CVE-2021-2"].exploits] == [1]
    assert queries.lookup_exploits(cves, table, "cve-2021-2").first().exploits[0].type == "remote"
    assert queries.lookup_exploits(cves, table, "CVE-1999-1").count() == 0


def test_links_equal_containment_for_ids_of_one_length(spark):
    numbers = F.array(*(F.format_string("CVE-2020-%05d", (F.col("id") * k) % 50) for k in (1, 3, 7, 7)))
    exploits = spark.range(1, 200).select("id", numbers.alias("cves"))
    cves = spark.range(60).select(F.format_string("CVE-2020-%05d", "id").alias("id"))
    linked = links.exploits_of_advisories(cves, exploits).select("cve_id", "exploit_id")
    named = exploits.select(F.col("id").alias("exploit_id"), F.to_json("cves").alias("text")).collect()
    want = sorted((c.id, e.exploit_id) for c in cves.collect() for e in named if c.id in e.text)
    assert sorted(map(tuple, linked.collect())) == want


def test_hot_advisory_is_split_in_the_join(spark):
    """A third of all links on one advisory: adaptive execution splits its partition in the join."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB", "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        number = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
        exploits = spark.range(0, 90_000, 1, 8).select(
            "id", F.array(F.concat(F.lit("CVE-"), number)).alias("cves"), F.sha2(F.col("id").cast("string"), 512).alias("note"))
        cves = spark.range(90_000).select(F.concat(F.lit("CVE-"), "id").alias("id"))
        joined = links.exploits_of_advisories(cves, exploits, "note")
        assert len(joined.collect()) == 90_000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_catalogue_files_of_different_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,description,platform\n1,"one, two",linux\n2,,\n3,short\n')
    (tmp_path / "b.csv").write_text("id,platform,description\n4,windows,four\n5,mac,five,more\n")
    found = {r.id: (r.description, r.platform) for r in read_catalogue(spark, str(tmp_path)).collect()}
    assert found == {"1": ("one, two", "linux"), "2": ("", ""), "3": ("short", None), "4": ("four", "windows"), "5": ("five", "mac")}


def test_hot_advisory_is_nested_in_blocks(spark):
    many = spark.range(1, 1000).select(
        "id", F.lit("d").alias("description"), F.lit("t").alias("type"), F.lit("p").alias("platform"),
        F.lit("m").alias("markdown"), F.lit("u").alias("url"), F.array(F.lit("CVE-1")).alias("cves"))
    assert links.nested_exploits(many).count() == 1
    nested = links.nested_exploits(many, 10).select(F.size("exploits").alias("n"))
    assert nested.agg(F.max("n"), F.sum("n")).first()[:] == (10, 999)


def test_missing_files(spark, catalogue, rows):
    present = spark.createDataFrame([("1.txt",), ("3.c",)], "basename string")
    missing = links.missing_files(read_catalogue(spark, catalogue), present)
    assert ("exploits/win/3b.c",) in rows(missing) and ("exploits/php/1.txt",) not in rows(missing)


def test_exploit_search(spark, catalogue):
    table = normalize_exploits(read_catalogue(spark, catalogue))
    assert [r.id for r in queries.exploits(table, "OVERFLOW", "win").collect()] == [3]
    assert queries.exploits(table, limit=0).count() == 0
    assert queries.exploits(table, limit=None).count() == 4
    with pytest.raises(ValueError, match="limit"):
        queries.exploits(table, limit=-1)
