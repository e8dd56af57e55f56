"""Feed documents written item by item and cut as they are read, so that no task holds a whole one."""

import gzip
import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from vulnatlas.operators.segments import open_index
from vulnatlas.plans import registry
from vulnatlas.plans.pipeline import append_indexed
from vulnatlas.sources import feed_cuts
from vulnatlas.sources.advisories import feed_items, read_feeds
from vulnatlas.streaming.ingest import ingest_feeds

AWKWARD = ["{", "}]", '"', "\\", '\\"', "[{", ",", "'", "é ", "", "{\"vulnerabilities\":[1]}"]


def item(n, text=""):
    return {"cve": {"id": f"CVE-2021-{n:05}", "published": "2021-01-01", "descriptions": [{"lang": "en", "value": text}]}}


def awkward_items(n):
    return [item(k, AWKWARD[k % len(AWKWARD)] * (k % 5)) for k in range(n)]


def cut(text, *edges):
    """Items of the cut documents of a text that comes in the pieces between ``edges`` of its braces, with their places."""
    parts = text.split(feed_cuts.BETWEEN)
    bounds = [0, *edges, len(parts)]
    pieces = [feed_cuts.BETWEEN.join(parts[a:b]) for a, b in zip(bounds, bounds[1:])]
    found, rest = {}, []
    for first, document in feed_cuts._cut(iter(pieces)):
        read = json.loads(document)
        rest.append({k: v for k, v in read.items() if k != feed_cuts.ITEMS})
        for k, value in enumerate(read.get(feed_cuts.ITEMS) or []):
            assert first + k not in found
            found[first + k] = value
    return [found[k] for k in range(len(found))], rest[-1]


def read(spark, path):
    return [(r.n, r.raw) for r in feed_items(feed_cuts.feed_text(spark.read, str(path))).select("source_order.n", "raw").collect()]


@pytest.mark.parametrize("bytes_", [1, 60, 1 << 20])
@pytest.mark.parametrize("indent", [None, 2])
def test_cut_documents_hold_all_items_in_order(monkeypatch, bytes_, indent):
    monkeypatch.setattr(feed_cuts, "CUT_BYTES", bytes_)
    draw = random.Random(7)
    items = [*awkward_items(40), None, 7, "a{b", [], [[{}, "]"]], {}, 1.5]
    beside = {"format": "{x", "other": [{"vulnerabilities": [1]}, [2]]}
    for document in ({**beside, "vulnerabilities": items}, {"vulnerabilities": items, **beside}, {"vulnerabilities": [], **beside}):
        text = json.dumps(document, indent=indent, ensure_ascii=False).encode()
        n = text.count(feed_cuts.BETWEEN) + 1
        for _ in range(30):
            edges = sorted(draw.sample(range(1, n), min(n - 1, draw.randrange(6))))
            assert cut(text, *edges) == (document["vulnerabilities"], beside)


def test_a_cut_document_is_small(monkeypatch):
    monkeypatch.setattr(feed_cuts, "CUT_BYTES", 2000)
    text = json.dumps({"vulnerabilities": awkward_items(500)}).encode()
    sizes = [len(d) for _, d in feed_cuts._cut(iter(text.split(feed_cuts.BETWEEN)))]
    assert len(sizes) > 20 and max(sizes) < 2500


@pytest.mark.parametrize("split", [False, True])
@pytest.mark.parametrize("packed", [False, True])
def test_items_of_cut_and_split_files(spark, tmp_path, monkeypatch, split, packed):
    monkeypatch.setattr(feed_cuts, "CUT_BYTES", 500)
    items = awkward_items(300)
    for name in "ab":
        text = json.dumps({"x": 1, "vulnerabilities": items, "y": "{"}, ensure_ascii=False).encode()
        path = tmp_path / f"{name}.json{'.gz' if packed else ''}"
        path.write_bytes(gzip.compress(text) if packed else text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000" if split else before)
    try:
        rows = read_feeds(spark, str(tmp_path)).select("source_order", "raw").orderBy("source_order.file", "source_order.n").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r.source_order.n for r in rows] == [*range(300)] * 2
    assert [json.loads(r.raw) for r in rows] == items * 2


def test_documents_that_spark_takes_or_refuses(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(feed_cuts, "CUT_BYTES", 1)
    taken = {
        b"[1, {\"a\": 1.50} ]": [(0, "1"), (1, '{"a":1.5}')], b"null": [], b"[]": [], b"['it\"s', {'a':\"'\"}]": [(0, '"it\\"s"'), (1, '{"a":"\'"}')],
        b'["\xed\xa0\x80\xf0\x80\x80\xe2\x82A\xff"]': [(0, '"�����A�"')],
    }
    documents = {b'{"vulnerabilities":' + k + b"}": v for k, v in taken.items()} | {
        b'{"vulner\\u0061bilities":[1]}': [(0, "1")], b'{"vulnerabilities":[1]} beyond': [(0, "1")], b' {"other":[1]}': [], b" \n": [],
        b'[{"vulnerabilities":[1]},{"vulnerabilities":[2,3]}]': [(0, "1"), (0, "2"), (1, "3")],
    }
    for k, (text, items) in enumerate(documents.items()):
        path = tmp_path / f"{k}.json"
        path.write_bytes(text)
        assert sorted(read(spark, path)) == items, text
    refused = [
        b"{", b"12", b"null", b'{"vulnerabilities":[1', b'{"vulnerabilities":[1]', b'{"vulnerabilities":[{"a":1},]}', b'{"vulnerabilities":[{"a":1},,{}]}',
        b'{"vulnerabilities":[{"a":1} {"a":2}]}', b'{"vulnerabilities":[{"a":1]}', b'{"vulnerabilities":[1],"x":tru}', b'{"vulnerabilities":{"a":1}}',
        b'{"vulnerabilities":[{"a":"b}]}', b'{"vulnerabilities":[1],"vulnerabilities":[2]}',
    ]
    for k, text in enumerate(refused):
        path = tmp_path / f"refused{k}.json.gz"
        path.write_bytes(gzip.compress(text))
        with pytest.raises(Exception, match="MALFORMED|FAILFAST|twice"):
            read(spark, path)


def test_stream_and_batch_read_the_same(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(feed_cuts, "CUT_BYTES", 300)
    landing = tmp_path / "feeds"
    landing.mkdir()
    for k in range(3):
        (landing / f"{k}.json.gz").write_bytes(gzip.compress(json.dumps({"vulnerabilities": [item(n, f"{k}{{") for n in range(10 * k, 10 * k + 20)]}).encode()))
    for limit in (None, 1):
        target = str(tmp_path / f"cves{limit}")
        ingest_feeds(spark, str(landing), target, str(tmp_path / f"checkpoint{limit}"), limit)
        assert sorted(r.id for r in spark.read.parquet(target).collect()) == [f"CVE-2021-{n:05}" for n in range(40)]


def test_an_append_of_feeds_reads_them_once(spark, tmp_path):
    """Rows are staged, as an append onto stored rows reads them up to three times, and nothing stays of it."""
    feed = tmp_path / "a.json.gz"
    shared = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    for number, added in ((5, 5), (8, 3), (8, 0)):
        feed.write_bytes(gzip.compress(json.dumps({"vulnerabilities": [item(n, "text") for n in range(number)] * 2}).encode()))
        assert append_indexed(spark, str(feed), str(tmp_path / "index"), stem=False, substring=None) == added
    assert sorted(r.id for r in open_index(spark, str(tmp_path / "index")).rows.collect()) == [f"CVE-2021-{n:05}" for n in range(8)]
    assert not [*shared.glob("advisories-*")]


def test_feeds_land_item_by_item(spark, tmp_path):
    """Each task writes one document a line for an item; before, it held the document as one text."""
    rows = [(n, f"text {n} {{", (None, "", "en", "de")[n % 4], "src", n) for n in range(400)] + [(None, "no id", "xx", "src", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    landing = registry.landed_feeds(spark, str(tmp_path))
    lines = spark.read.text(landing).select(F.input_file_name().alias("file"), "value").collect()
    files = {}
    for line in lines:
        files.setdefault(line.file, []).append(line.value)
    assert len(files) == len({(n % 26, n % 4) for n in range(400)})
    read_back = []
    for text in files.values():
        feed = json.loads("\n".join(text))["vulnerabilities"]
        assert len(text) == len(feed) + 1
        ids = [int(i["cve"]["id"].split("-")[2]) for i in feed]
        assert ids == sorted(ids) and len({(n % 26, n % 4) for n in ids}) == 1
        read_back += ids
    assert sorted(read_back) == [*range(400)]
    assert read_feeds(spark, f"{landing}/*.gz").count() == 400


def test_no_feeds_land_of_no_documents(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    assert read_feeds(spark, registry.landed_feeds(spark, str(tmp_path))).count() == 0
