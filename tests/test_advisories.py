"""Advisory feeds: nested items to the table, document store, incremental ingest."""

from __future__ import annotations

import gzip
import json

import pytest
from pyspark.sql import functions as F

from vulnatlas.operators.normalize import normalize_advisories
from vulnatlas.plans.pipeline import advisory_table, append_advisories
from vulnatlas.sinks.writers import write_documents
from vulnatlas.sources.advisories import feed_glob, read_feeds
from vulnatlas.streaming.ingest import ingest_feeds


def metric(score, severity=None, element=None, vector="V"):
    data = {"baseScore": score, "baseSeverity": severity, "vectorString": vector}
    return {"cvssData": data, **({"baseSeverity": element} if element else {})}


def cve(cve_id, **fields):
    return {"cve": {"id": cve_id, "published": "2021-12-10T10:15:09.143", **fields}}


def english(text):
    return [{"lang": "en", "value": text}]


FEED_2021 = [
    cve("CVE-2021-0001", lastModified="2022", sourceIdentifier="src", vulnStatus="Analyzed",
        descriptions=[{"lang": "es", "value": "hola"}, *english("hello"), *english("again")],
        metrics={"cvssMetricV31": [metric(9.8, "CRITICAL", vector="31")], "cvssMetricV2": [metric(5.0, element="MEDIUM")]},
        weaknesses=[{"description": english("NVD-CWE-noinfo")}, {"description": english("CWE-79")}],
        references=[{"url": "u1", "tags": ["A", "B"]}, {"tags": None}, {"url": "u1", "tags": ["B", "C"]}],
        unknownField={"kept": [1, 2]}),
    cve("CVE-2021-0002", descriptions=[{"lang": "es", "value": "hola"}],
        metrics={"cvssMetricV40": [], "cvssMetricV2": [metric(5.0, element="MEDIUM", vector="2")]}),
    cve("CVE-2021-0003", metrics={"cvssMetricV40": [metric(None, "HIGH")], "cvssMetricV31": [metric(7.0, "HIGH")]}),
    cve("CVE-2021-0004"),
    cve("", descriptions=english("no id")),
    {"cve": {"descriptions": english("no id either")}},
    cve("CVE-2021-0001", descriptions=english("second delivery")),
]


def write_feed(directory, year, items):
    directory.mkdir(exist_ok=True)
    with gzip.open(directory / f"nvdcve-2.0-{year}.json.gz", "wt", encoding="utf-8") as fh:
        json.dump({"format": "x", "vulnerabilities": items}, fh, ensure_ascii=False)


@pytest.fixture
def feeds(tmp_path):
    directory = tmp_path / "feeds"
    write_feed(directory, 2021, FEED_2021)
    write_feed(directory, 2023, [cve("CVE-2023-0001", published="2023-01-01T00:00:00.000")])
    return str(directory)


def test_normalized_rows(spark, feeds):
    table = {r.id: r for r in advisory_table(spark, feed_glob(feeds, 2021, 2021)).collect()}
    assert sorted(table) == ["CVE-2021-0001", "CVE-2021-0002", "CVE-2021-0003", "CVE-2021-0004"]
    first = table["CVE-2021-0001"]
    assert (first.description, first.severity, first.cvss, first.cvss_vector) == ("hello", "CRITICAL", 9.8, "31")
    assert (first.cwe, first.refs, first.ref_tags) == ("CWE-79", ["u1", "", "u1"], ["A", "B", "C"])
    assert (first.source, first.status, first.last_modified, first.year) == ("src", "Analyzed", "2022", 2021)
    assert first.published_ts.isoformat() == "2021-12-10T10:15:09.143000"
    second = table["CVE-2021-0002"]
    assert (second.description, second.severity, second.cvss, second.cvss_vector) == ("", "MEDIUM", 5.0, "2")
    third = table["CVE-2021-0003"]
    assert (third.severity, third.cvss) == ("HIGH", None)
    fourth = table["CVE-2021-0004"]
    assert (fourth.severity, fourth.cvss, fourth.cwe, fourth.refs, fourth.ref_tags) == (None, None, None, [], [])


def test_normalisation_has_no_shuffle_of_its_own(spark, feeds, plan):
    items = read_feeds(spark, feed_glob(feeds, 2021, 2021))
    assert plan(normalize_advisories(items)).count("Exchange") == plan(items).count("Exchange")


def test_year_range_and_floor(spark, feeds):
    assert read_feeds(spark, feed_glob(feeds, 1999, 2022)).count() == 5
    assert read_feeds(spark, feed_glob(feeds, 2022, 2026)).select("cve.id").first().id == "CVE-2023-0001"
    assert "1999" not in feed_glob(feeds, 1999, 2003)


def test_limit_keeps_feed_order(spark, feeds):
    ids = [r.id for r in read_feeds(spark, feed_glob(feeds, 2021, 2023), limit=2).select("cve.id").collect()]
    assert sorted(ids) == ["CVE-2021-0001", "CVE-2021-0002"]


def test_undecodable_bytes_are_replaced_and_bad_documents_fail(spark, tmp_path):
    good = tmp_path / "nvdcve-2.0-2024.json.gz"
    text = json.dumps({"vulnerabilities": [cve("CVE-2024-1", descriptions=english("caf?"))]}).encode()
    good.write_bytes(gzip.compress(text.replace(b"caf?", b"caf\xe9")))
    assert normalize_advisories(read_feeds(spark, str(good))).first().description == "caf�"
    bad = tmp_path / "nvdcve-2.0-2025.json.gz"
    bad.write_bytes(gzip.compress(b'{"vulnerabilities": [{"cve": '))
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        read_feeds(spark, str(bad)).collect()


def test_document_store_keeps_first_raw_item(spark, feeds, tmp_path):
    store = str(tmp_path / "store")
    items = read_feeds(spark, feed_glob(feeds, 2021, 2023))
    assert write_documents(items, store) == 5
    assert write_documents(items, store) == 0
    stored = spark.read.parquet(store)
    assert sorted(p.name for p in (tmp_path / "store").iterdir() if p.is_dir()) == ["year=2021", "year=2023"]
    raw = json.loads(stored.filter("id = 'CVE-2021-0001'").first().raw)
    assert raw["cve"]["unknownField"] == {"kept": [1, 2]}
    assert raw["cve"]["descriptions"][1]["value"] == "hello"


def test_append_skips_stored_advisories(spark, feeds, tmp_path):
    path = str(tmp_path / "cves")
    assert [append_advisories(spark, feed_glob(feeds, 2002, last), path) for last in (2021, 2023, 2023)] == [4, 1, 0]
    assert spark.read.parquet(path).filter("id = 'CVE-2021-0001'").first().description == "hello"


def test_incremental_ingest(spark, feeds, tmp_path):
    target, checkpoint = str(tmp_path / "cves"), str(tmp_path / "checkpoint")
    ingest_feeds(spark, feeds, target, checkpoint)
    assert spark.read.parquet(target).count() == 5
    write_feed(tmp_path / "feeds", 2024, [
        cve("CVE-2023-0001", descriptions=english("changed")), cve("CVE-2024-0001", published="2024-05-05")])
    for _ in range(2):
        ingest_feeds(spark, feeds, target, checkpoint)
        table = spark.read.parquet(target)
        assert table.count() == 6
        assert table.filter("id = 'CVE-2023-0001'").first().description == ""
    pruned = table.filter(F.col("year") == 2024).select("id")
    assert [r.id for r in pruned.collect()] == ["CVE-2024-0001"]
    assert "PartitionFilters: [isnotnull(year" in pruned._jdf.queryExecution().toString()
