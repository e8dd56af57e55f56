"""Writeup trees: scan, index and search."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from vulnatlas.functions import columns as C
from vulnatlas.operators.normalize import index_writeups
from vulnatlas.plans import queries
from vulnatlas.sources.writeups import read_writeups, skipped_writeups, unlisted_writeups

FILES = {
    "top.md": b"# Title \nbody",
    "repo/a b/deep.TXT": b"\r\n  \n  first line \r\nsecond",
    "repo/long.py": b"x" * 200,
    "repo/empty.md": b"",
    "repo/latin.md": b"caf\xe9",
    "repo/hash.md": b"#  \nnext",
    "repo/picture.PNG": b"\x89PNG",
    "repo/_repos.json": b"{}",
    "repo/.hidden.md": b"# hidden",
    "repo/noext": b"# none",
}


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("writeups")
    for name, content in FILES.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(content)
    return index_writeups(read_writeups(spark, str(root)))


def test_index(index):
    found = {r.path.removeprefix("data/writeups/"): r for r in index.collect()}
    assert sorted(found) == ["repo/a b/deep.TXT", "repo/hash.md", "repo/latin.md", "repo/long.py", "top.md"]
    assert (found["top.md"].title, found["top.md"].repo, found["top.md"].size) == ("Title", ".", 13)
    deep = found["repo/a b/deep.TXT"]
    assert (deep.title, deep.repo, deep.ext) == ("first line", "repo/a b", ".txt")
    assert found["repo/long.py"].title == "x" * 120
    assert found["repo/latin.md"].title == "caf�"
    assert found["repo/hash.md"].title == "#"


def test_rows_may_be_landed_instead_of_files(spark):
    rows = spark.createDataFrame(
        [("r/_sidebar.md", "# Side", 6), ("r/empty.md", "", 0), ("r/_repos.json", "{}", 2), (".x/y.md", "hi", 2), ("r/.z.md", "hi", 2)],
        "path string, content string, size bigint")
    titles = {r.path: r.title for r in index_writeups(rows).collect()}
    assert titles == {"data/writeups/.x/y.md": "hi", "data/writeups/r/_sidebar.md": "Side", "data/writeups/r/empty.md": ""}


def test_search_is_literal(index):
    assert [r.title for r in queries.writeups(index, "FIRST").collect()] == ["first line"]
    assert queries.writeups(index, "a b").count() == 1
    assert queries.writeups(index, "_").count() == 0


@pytest.mark.parametrize(("name", "ext"), [
    ("a.md", ".md"), ("a.tar.GZ", ".gz"), (".bashrc", ""), ("..x.md", ".md"), ("noext", ""), ("a.", "."), (".a.py", ".py"),
])
def test_extension(spark, name, ext):
    assert spark.range(1).select(C.file_extension(F.lit(name)).alias("e")).first().e == ext


def test_what_a_scan_leaves_out_is_told(spark, tmp_path):
    for name, content in {
        "a/x.md": b"# A", "a/b.MD": b"caf\xe9", "a/pic.png": b"1", "e.txt": b"", "_repos.json": b"{}", "r/_repos.json": b"{}", ".git/c.md": b"x", "a/_y.md": b"y", "a/none": b"z",
    }.items():
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content)
    skipped = {(r.path, r.reason) for r in skipped_writeups(spark, str(tmp_path)).collect()}
    assert skipped == {("a/pic.png", "extension"), ("a/none", "extension"), ("a/b.MD", "not UTF-8")}
    unlisted = {path: reason for path, reason in unlisted_writeups(spark, str(tmp_path)) if not path.endswith(".crc")}
    assert unlisted == dict.fromkeys([".git/c.md", "_repos.json", "a/_y.md", "r/_repos.json"], "hidden") | {"e.txt": "empty"}
