"""Archive records written, derived and read back."""

from __future__ import annotations

import gzip
import zlib

import pytest
import zstandard

from vulnatlas.llm import warc


def test_plain_text():
    page = '<html><head><title>A &amp; B</title><style>p{}</style><script>var t="</p>";</script></head><!-- x --><p>one<br>two <b>three</b><p>1 < 2'
    assert warc.plain_text(page) == "A & B\none\ntwo three\n1 < 2"
    assert warc.plain_text("") == "" and warc.plain_text("<script>never closed") == ""


def test_records_of_members_and_plain_bytes():
    data = warc.response("1", "http://a\r\nb", "é") + warc.response("2", "http://c", "x" * 200_000)
    first, second = warc.records(data)
    assert dict(first[0])["WARC-Target-URI"] == "http://a b" and first[1].endswith("é".encode())
    assert list(warc.records(gzip.decompress(data))) == [first, second]
    with pytest.raises(ValueError):
        list(warc.records(data[:-10]))


def test_round_trip(spark):
    long = "<p>word</p>" * 30_000
    pages = [(1, "http://a", "<p>Hello</p>"), (2, None, None), (None, "http://b", "<p>x"), (3, "", long), (3, "", long)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "1 AS record_id", "2 AS type")
    rows = warc.round_trip(df).collect()
    assert len(rows) == 2 * len(pages) and all(r.intact for r in rows)
    by_source = {}
    for r in rows:
        by_source.setdefault((r.page_id, r.refers_to), []).append(r.type)
        expected = dict((i or None, (u or "", h or "")) for i, u, h in pages)[r.page_id]
        assert r.url == expected[0] and r.source_digest == warc.digest(expected[1].encode())
        if r.type == "conversion":
            assert r.block_digest == warc.digest(warc.plain_text(expected[1]).encode())
    assert {tuple(sorted(set(types))) for types in by_source.values()} == {("conversion", "metadata")}
    assert warc.round_trip(df.limit(0)).collect() == []


def test_source_headers_and_links():
    (headers, block), = warc.records(warc.response("7", "http://u", "<p>t"))
    (meta, facts), (conv, text) = (next(warc.records(r)) for r in warc.derivatives(headers, block))
    source = dict(headers)
    for got in (dict(meta), dict(conv)):
        assert got["WARC-Refers-To"] == source["WARC-Record-ID"]
        assert {n: got[f"Source-{n}"] for n in ("X-Page-Id", "WARC-Payload-Digest", "Content-Type")} == {
            n: source[n] for n in ("X-Page-Id", "WARC-Payload-Digest", "Content-Type")}
    assert text == b"t" and dict(meta)["WARC-Concurrent-To"] == dict(conv)["WARC-Record-ID"] and b"payload-length: 4" in facts


def foreign(body, *http, names=str.lower, record="<urn:x:1>"):
    """A response as another writer puts it, uncompressed."""
    block = b"HTTP/1.1 200 OK\r\n" + b"".join(h.encode() + b"\r\n" for h in http) + b"\r\n" + body
    head = [("WARC-Type", "response"), ("WARC-Target-URI", "http://f"), ("Content-Length", str(len(block)))] + ([("WARC-Record-ID", record)] if record else [])
    return b"WARC/1.0\r\n" + b"".join(f"{names(n)}: {v}\r\n".encode() for n, v in head) + b"\r\n" + block + b"\r\n\r\n"


PAGE = "<p>Grüße</p>".encode()
CHUNKED = b"5;x=y\r\n" + PAGE[:5] + b"\r\n" + b"%x\r\n" % (len(PAGE) - 5) + PAGE[5:] + b"\r\n0\r\n\r\n"
COMPRESSOR = zlib.compressobj(wbits=-15)
RAW_DEFLATE = COMPRESSOR.compress(PAGE) + COMPRESSOR.flush()


@pytest.mark.parametrize("body, http, text", [
    (PAGE, (), "Grüße"), (CHUNKED, ("Transfer-encoding: Chunked",), "Grüße"), (gzip.compress(PAGE), ("content-encoding: gzip",), "Grüße"),
    (zlib.compress(PAGE), ("Content-Encoding: deflate",), "Grüße"), (RAW_DEFLATE, ("Content-Encoding: deflate",), "Grüße"),
    (zstandard.compress(PAGE), ("Content-Encoding: zstd",), "Grüße"), (PAGE, ("Content-Encoding: gzip", "Transfer-Encoding: chunked"), "Grüße"),
    ("<p>Grüße".encode("latin-1"), ('Content-Type: text/html; charset="iso-8859-1"',), "Grüße"), (b"??", ("Content-Encoding: br",), ""),
    (CHUNKED[:14], ("Transfer-Encoding: chunked",), "Gr"), (PAGE, ("Content-Type: text/html; charset=none-such",), "Grüße"),
])
def test_bodies_of_other_writers(body, http, text):
    (headers, block), = warc.records(foreign(body, *http))
    _, (conversion, found) = (next(warc.records(r)) for r in warc.derivatives(headers, block))
    assert found.decode()[:len(text)] == text and bool(found) == bool(text) and dict(conversion)["WARC-Refers-To"] == "<urn:x:1>"


def test_broken_members_are_counted_and_passed_over(spark, tmp_path):
    good = [gzip.compress(foreign(f"<p>{k}".encode(), names=(str.lower, str.upper)[k % 2], record=k and f"<urn:x:{k}>")) for k in range(4)]
    damaged = bytearray(good[1])
    damaged[len(damaged) // 2] ^= 255
    (tmp_path / "a.warc.gz").write_bytes(good[0] + bytes(damaged) + good[2] + good[3][:-20])
    (tmp_path / "b.warc").write_bytes(b"".join(map(gzip.decompress, good[:2])) + b"junk\r\n\r\n" + gzip.decompress(good[3]))
    (tmp_path / "c.warc.gz").write_bytes(gzip.compress(b"".join(map(gzip.decompress, good))) + bytes(64))
    (tmp_path / "d.warc.gz").write_bytes(b"")
    out = str(tmp_path / "out")
    rows = warc.build_derivatives(spark, str(tmp_path), out).collect()
    assert sum(r.broken for r in rows if r.file is None) == 3 and sum(r.records for r in rows) == 2 * (2 + 3 + 4)
    found = warc.read_records(spark, out).filter("type = 'conversion'").collect()
    assert sorted(r.block for r in found) == sorted("02" + "013" + "0123") and all(r.intact and r.url == "http://f" for r in found)
