"""The segmented index: appended to, searched, merged, stopped half-way, and compared with one built at once."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from vulnatlas.operators import segments
from vulnatlas.operators.key_filters import key_filter, may_be_stored, words_for
from vulnatlas.operators.limits import first_rows
from vulnatlas.operators.match_tree import But, Near, Words, all_of, any_of, match_tree, prefix
from vulnatlas.operators.postings import build_postings
from vulnatlas.operators.segments import append_segment, merge_segments, open_index, search_index, substring_search, vacuum
from vulnatlas.sinks import manifest
from vulnatlas.streaming.ingest import ingest_indexed

SCHEMA = "id string, published string, severity string, cvss double, cwe string, description string"
WORDS = "apache server code executing executes remote log4j bash the of in child process 100% naïve".split()


def advisories(n, seed=1):
    rng = random.Random(seed)
    return [
        (f"CVE-{2000 + k % 20}-{k:05d}", f"{2000 + k % 20}-01-01", rng.choice(["HIGH", "LOW", None]), rng.choice([None, 0.0, 5.5, 9.8, 10.0, rng.randint(0, 99) / 10]),
         f"CWE-{k % 9}", " ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 12))))
        for k in range(n)
    ]


@pytest.fixture(scope="module")
def rows():
    return advisories(400)


@pytest.fixture(scope="module")
def grown(spark, rows, tmp_path_factory):
    """Three deliveries that overlap, one of them twice."""
    root = str(tmp_path_factory.mktemp("index") / "cves")
    parts = [rows[:200], rows[150:300], rows[150:300], rows[290:] + rows[:10]]
    counts = [append_segment(spark, spark.createDataFrame(part, SCHEMA), root) for part in parts]
    assert counts == [200, 100, 0, 100]
    return root


def ordered(found, rows, limit):
    known = {row[0]: row for row in rows}
    best = sorted((known[i] for i in found), key=lambda r: (r[3] is None, -(r[3] or 0), r[0]))
    return [r[0] for r in (best if limit is None else best[:limit])]


TREES = [Words("apache"), prefix("executing"), all_of("log4j", "remote code"), But(any_of("bash", prefix("proc")), Words("the")),
         Near(("apache server", "child"), 2), all_of("log4j", "nowhere")]


@pytest.mark.parametrize("tree", TREES, ids=range(len(TREES)))
def test_search_equals_an_index_built_at_once(spark, rows, grown, tree):
    whole = spark.createDataFrame(rows, SCHEMA)
    hits = {r.id for r in match_tree(build_postings(whole, stem=True), tree).collect()}
    index = open_index(spark, grown)
    for limit in (None, 1, 7, 1000):
        got = [r.id for r in search_index(index, tree, limit).collect()]
        assert (sorted(got) if limit is None else got) == (sorted(hits) if limit is None else ordered(hits, rows, limit))
    picked = {r[0] for r in rows if r[0] in hits and r[2] == "HIGH" and r[1] >= "2005" and (r[3] or 0) >= 5.5}
    got = search_index(index, tree, 20, severity="high", since=2005, min_cvss=5.5)
    assert [r.id for r in got.collect()] == ordered(picked, rows, 20) and "block" not in got.columns


def test_merge_and_vacuum_change_nothing(spark, rows, tmp_path):
    root = str(tmp_path / "merged")
    for part in (rows[:100], rows[100:120], rows[120:150]):
        append_segment(spark, spark.createDataFrame(part, SCHEMA), root)
    before = open_index(spark, root)
    parts = {name: sorted(map(str, before.part(name).collect())) for name in ("rows", "postings", "grams")}
    terms = sorted(map(tuple, before.terms().collect()))
    assert merge_segments(spark, root, 50) == 2 and merge_segments(spark, root, 50) == 0
    after = open_index(spark, root)
    assert sorted(s["rows"] for s in after.segments) == [50, 100] and after.blocks() == before.blocks()
    assert {name: sorted(map(str, after.part(name).collect())) for name in parts} == parts
    assert sorted(map(tuple, after.terms().collect())) == terms
    assert before.rows.count() == 150  # a reader of the older state still finds its files
    assert len(vacuum(spark, root)) == 2 and vacuum(spark, root) == []
    assert append_segment(spark, spark.createDataFrame(rows[:150], SCHEMA), root) == 0
    assert merge_segments(spark, root) == 2 and open_index(spark, root).rows.count() == 150


def test_an_append_stopped_before_its_state_leaves_nothing(spark, rows, tmp_path, monkeypatch):
    root = str(tmp_path / "stopped")
    append_segment(spark, spark.createDataFrame(rows[:50], SCHEMA), root)
    with monkeypatch.context() as patched:
        patched.setattr(segments, "publish_state", lambda *_: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError, match="stopped"):
            append_segment(spark, spark.createDataFrame(rows[50:80], SCHEMA), root)
    assert open_index(spark, root).rows.count() == 50
    (tmp_path / "stopped" / "_states" / "000000000002.json").write_text('{"segments": [')  # a writer that died while it wrote
    assert open_index(spark, root).rows.count() == 50
    assert append_segment(spark, spark.createDataFrame(rows[50:80], SCHEMA), root) == 30
    assert open_index(spark, root).rows.count() == 80 and len(vacuum(spark, root)) == 1
    assert len(search_index(open_index(spark, root), Words("apache"), None).collect()) == sum("apache" in r[5] for r in rows[:80])


def test_of_two_writers_one_fails(spark, rows, tmp_path):
    root = str(tmp_path / "two")
    append_segment(spark, spark.createDataFrame(rows[:5], SCHEMA), root)
    number, state = manifest.read_state(spark, root)
    append_segment(spark, spark.createDataFrame(rows[5:9], SCHEMA), root)
    with pytest.raises(manifest.StateMoved):
        manifest.publish_state(spark, root, number, state)
    with pytest.raises(ValueError, match="was made with"):
        append_segment(spark, spark.createDataFrame(rows[:5], SCHEMA), root, stem=False)
    assert append_segment(spark, spark.createDataFrame([], SCHEMA), root) == 0


def test_the_best_rows_are_found_in_few_blocks(spark, rows, grown, plan):
    index = open_index(spark, grown)
    assert list(index.blocks()) == sorted(index.blocks(), reverse=True) and sum(index.blocks().values()) == 400
    few = plan(search_index(index, Words("the"), 3))
    assert re.search(r"PartitionFilters: \[[^]]*block#\d+ (IN|=)", few)
    read = segments.blocks_for(index, lambda some: index.rows.filter(F.col("block").isin(some)), 3, index.blocks(), 1.0)
    assert read == [10]
    asked = []
    segments.blocks_for(index, lambda some: asked.append(some) or index.rows.limit(0), 5, index.blocks(), 1.0)
    assert asked[0] == [10] and len(asked[-1]) < len(index.blocks())  # widened until all blocks are taken


def test_rare_words_narrow_the_scan(spark, rows, tmp_path, plan):
    root = str(tmp_path / "rare")
    append_segment(spark, spark.createDataFrame([*rows[:200], ("CVE-2020-99999", "2020-01-01", "HIGH", 1.0, "x", "the apache zebra")], SCHEMA), root)
    index = open_index(spark, root)
    found = segments.matching_ids(index, all_of("the", "zebra"))
    text = plan(found)
    assert "BroadcastHashJoin" in text and "EqualTo(token,zebra)" in text
    assert [r.id for r in found.collect()] == ["CVE-2020-99999"]
    assert "LocalTableScan <empty>" in plan(segments.matching_ids(index, all_of("the", "unheard")))


def test_random_deliveries_equal_the_anti_join(spark, tmp_path):
    rng, root, known = random.Random(3), str(tmp_path / "random"), {}
    for step in range(5):
        batch = [(f"K{rng.randint(0, 120)}" if rng.random() < 0.98 else None, "2020", "LOW", rng.choice([1.0, 9.9]), "c", f"step {step} {k}") for k in range(40)]
        new = {}
        for row in sorted(batch, key=str):
            new.setdefault(row[0], row)
        added = {k: r for k, r in new.items() if k is None or k not in known}
        assert append_segment(spark, spark.createDataFrame(batch, SCHEMA), root, "description") == len(added)
        known |= {k: r for k, r in added.items() if k}
    assert {r.id for r in open_index(spark, root).rows.filter("id IS NOT NULL").collect()} == set(known)


def test_a_stream_becomes_searchable_and_restarts(spark, rows, tmp_path):
    landing, root, checkpoint = (str(tmp_path / name) for name in ("landing", "index", "checkpoint"))
    for part in (rows[:60], rows[40:120], []):
        if part:
            spark.createDataFrame(part, SCHEMA).write.mode("append").parquet(landing)
        ingest_indexed(spark.readStream.schema(SCHEMA).parquet(landing), root, checkpoint)
    index = open_index(spark, root)
    assert [s["rows"] for s in index.segments] == [60, 60] and list(index.state["batches"].values()) == [1]
    # A batch that was published before the stream noted it comes again.
    (stream, number), = index.state["batches"].items()
    assert append_segment(spark, spark.createDataFrame(rows[200:], SCHEMA), root, batch=(stream, number)) == 0
    assert [r.id for r in search_index(index, Words("log4j"), 5).collect()] == ordered({r[0] for r in rows[:120] if "log4j" in r[5]}, rows, 5)


def test_without_grams(spark, rows, tmp_path):
    root = str(tmp_path / "plain")
    for part in (rows[:20], rows[20:50]):
        append_segment(spark, spark.createDataFrame(part, SCHEMA), root, substring=None)
    assert merge_segments(spark, root) == 2
    got = substring_search(open_index(spark, root), "log4j", None, column="description")
    assert sorted(r.id for r in got.collect()) == sorted(r[0] for r in rows[:50] if "log4j" in r[5])


def test_new_keys_read_no_stored_key(spark, rows, grown, monkeypatch):
    read, part = [], segments.Index.part
    monkeypatch.setattr(segments.Index, "part", lambda self, name, some=None: read.append(name) or part(self, name, some))
    index = open_index(spark, grown)
    fresh = spark.createDataFrame([("CVE-1990-00001",), ("CVE-1990-00002",)], "id string")
    assert segments.unseen(index, fresh, "id").count() == 2 and "rows" not in read
    assert segments.unseen(index, spark.createDataFrame([(rows[3][0],)], "id string"), "id").count() == 0 and "rows" in read


def test_key_filter(spark):
    stored = spark.range(20_000).selectExpr("CONCAT('key', id) AS id")
    words = words_for(20_000)
    bits = key_filter(stored, "id", words)
    other = spark.range(20_000).selectExpr("CONCAT('other', id) AS id")
    assert may_be_stored(stored, "id", bits, words).count() == 20_000
    assert may_be_stored(other, "id", bits, words).count() < 600


def test_substrings(spark, rows, grown, plan):
    index = open_index(spark, grown)
    rng = random.Random(6)
    texts = [r[5] for r in rows if r[5]]
    asked = ["", "z", "he", "100%", "NAÏVE c", "e remote", "nowhere at all", "the the", "%", "_"]
    for _ in range(8):
        text = rng.choice(texts)
        at = rng.randrange(len(text))
        asked.append(text[at:at + rng.randint(1, 9)].upper())
    for text in asked:
        got = sorted(r.id for r in substring_search(index, text, None).collect())
        assert got == sorted(r[0] for r in rows if text.lower() in r[5].lower()), text
    best = substring_search(index, "log4j", 4, severity="HIGH")
    assert [r.id for r in best.collect()] == ordered({r[0] for r in rows if "log4j" in r[5] and r[2] == "HIGH"}, rows, 4)
    assert "In(id, [CVE-" in plan(substring_search(index, "naïve remote log4j", None))


def test_large_limits_are_cut_by_ranges(spark, plan):
    df = spark.range(60_000).selectExpr("id", "id % 7 AS score").repartition(6)
    cut = first_rows(df, 50_000, F.desc("score"), "id")
    want = sorted(((k % 7, k) for k in range(60_000)), key=lambda r: (-r[0], r[1]))[:50_000]
    assert sorted((r.score, r.id) for r in cut.collect()) == sorted(want) and cut.columns == df.columns
    assert first_rows(df, 5_000_000, "id").count() == 60_000
    assert "TakeOrderedAndProject" not in plan(first_rows(df, 5_000_000, "id")) and "GlobalLimit" not in plan(first_rows(df, 5_000_000, "id"))
    assert [r.id for r in first_rows(df, 3, "id").collect()] == [0, 1, 2]
