"""Stored links, unified diffs, kept summaries, and all tables published as one state."""

from __future__ import annotations

import difflib
import random
import re

import pytest
from pyspark.sql import functions as F

from vulnatlas.operators import diffs, link_store, segments, summaries
from vulnatlas.sinks import manifest, writers
from vulnatlas.sources.tables import read_together
from vulnatlas.streaming.ingest import ingest_latest, latest_state

EXPLOIT = "id long, cves array<string>, description string, type string, platform string, markdown string, url string"


def exploits(spark, *ids):
    rows = [(k, [f"CVE-{k % 5}", f"CVE-{k % 7}", f"CVE-{k % 5}"] if k % 4 else [], f"d{k}", "t", "p", "m", "u") for k in ids]
    return spark.createDataFrame(rows, EXPLOIT)


@pytest.fixture(scope="module")
def linked(spark):
    cves = spark.createDataFrame([(f"CVE-{k}", "HIGH") for k in range(6)] + [(None, "LOW")], "id string, severity string")
    link_store.store_links(cves, exploits(spark, *range(20)), "cves_by_id", "exploit_links", 8)
    assert link_store.add_links(exploits(spark, *range(10, 60)), "exploit_links") > 0
    assert link_store.add_links(exploits(spark, *range(60)), "exploit_links") == 0
    return "cves_by_id", "exploit_links"


def pairs():
    return sorted({(c, k) for k in range(60) if k % 4 for c in (f"CVE-{k % 5}", f"CVE-{k % 7}") if c != "CVE-6"})


def test_stored_links(spark, linked):
    rows = link_store.stored_links(spark, *linked).collect()
    assert sorted((r.cve_id, r.exploit_id) for r in rows) == pairs() and {r.severity for r in rows} == {"HIGH"}
    got = link_store.stored_lookup(spark, *linked, "cve-3").collect()
    assert sorted(r.exploitdb_id for r in got) == [k for c, k in pairs() if c == "CVE-3"]
    assert link_store.stored_lookup(spark, *linked, "CVE-6").collect() == []  # linked, but no known advisory


def test_joins_and_lookups_move_nothing(spark, linked, plan):
    joined = plan(link_store.stored_links(spark, *linked)).split("== Physical Plan ==")[1]
    assert "SortMergeJoin" in joined and "Exchange" not in joined and joined.count("SelectedBucketsCount: 8 out of 8") == 2
    looked = plan(link_store.stored_lookup(spark, *linked, "CVE-3")).split("== Physical Plan ==")[1]
    assert "Exchange" not in looked and looked.count("SelectedBucketsCount: 1 out of 8") == 2


def plain_lines(diff):
    """Lines of a unified diff, read one after the other with the counts that are left."""
    out, file, old_file, hunk, o, n, left_o, left_n = [], None, None, 0, 0, 0, 0, 0
    for line in diff.split("\n"):
        if left_o > 0 or left_n > 0:
            if line[:1] in ("+", "-", " ", ""):
                kind = {"+": "added", "-": "removed"}.get(line[:1], "context")
                out.append((old_file if file == "/dev/null" else file, hunk, kind, o if kind != "added" else None, n if kind != "removed" else None, line[1:]))
                left_o, o = (left_o - 1, o + 1) if kind != "added" else (left_o, o)
                left_n, n = (left_n - 1, n + 1) if kind != "removed" else (left_n, n)
            continue
        if found := re.match(r"@@ -(\d+)(?:,(\d+))? \+(\d+)(?:,(\d+))? @@", line):
            hunk += 1
            o, n = int(found[1]), int(found[3])
            left_o, left_n = (int(x) if x is not None else 1 for x in (found[2], found[4]))
        elif line.startswith("--- "):
            old_file = re.sub("^[ab]/", "", line[4:].split("\t")[0])
        elif line.startswith("+++ "):
            file = re.sub("^[ab]/", "", line[4:].split("\t")[0])
    return out


def made_diffs():
    rng, out = random.Random(2), []
    lines = ["a", "", "-- x", "++ y", "@@ z", "+", "-", "b c", "--- q", "+++ q"]
    for k in range(25):
        text = ""
        for f in range(rng.randint(1, 3)):
            old = [rng.choice(lines) for _ in range(rng.randint(0, 30))]
            new = [line for line in old if rng.random() > 0.2]
            for _ in range(rng.randint(0, 4)):
                new.insert(rng.randint(0, len(new)), rng.choice(lines))
            text += "".join(f"{line}\n" for line in difflib.unified_diff(old, new, f"a/f{f}.c", f"b/f{f}.c" if rng.random() < 0.9 else "/dev/null", n=rng.randint(0, 3), lineterm=""))
        out.append((k % 20, text))
    return [*out, (90, None), (91, ""), (92, "no diff\nat all"), (93, "@@ -1,2 +1 @@\n-cut off"), (94, out[0][1]), (94, out[0][1])]


def test_diffs_equal_a_plain_reading(spark):
    rows = made_diffs()
    patches = spark.createDataFrame(rows, "id long, diff string").withColumn("line_count", F.lit(1))
    got = [(r.id, r.file, r.hunk, r.side, r.old_line, r.new_line, r.line) for r in diffs.diff_lines(patches).collect()]
    want = [(i, *line) for i, text in rows for line in plain_lines((text or "").removesuffix("\n"))]
    assert sorted(got, key=repr) == sorted(want, key=repr) and len(want) > 300
    added = diffs.changed_lines(patches, "B C", "added", "F1").collect()
    assert sorted(r.id for r in added) == sorted(w[0] for w in want if w[3] == "added" and "b c" in w[6] and "f1" in (w[1] or ""))


def test_summaries_add_up(spark, tmp_path):
    rows = spark.range(3000).selectExpr(
        "CONCAT('K', id) AS id", "CONCAT(2000 + id % 5, '-01-01') AS published", "IF(id % 3 = 0, NULL, 'HIGH') AS severity",
        "CONCAT('CWE-', id % 11) AS cwe", "CONCAT('s', id % 700) AS source", "IF(id % 2 = 0, NULL, (id % 100) / 10.0D) AS cvss", "'x' AS description").cache()
    root = str(tmp_path / "index")
    for cut in ("id < 'K2'", "id < 'K5'", "true"):
        segments.append_segment(spark, rows.filter(cut), root, substring=None)
    segments.merge_segments(spark, root)
    parts = segments.open_index(spark, root).part("summary")
    year = F.col("published").substr(1, 4).alias("year")
    assert sorted(map(tuple, summaries.kept_severity_counts(parts).collect()), key=str) == sorted(map(tuple, rows.groupBy("severity").count().collect()), key=str)
    assert sorted((r.year, r.n) for r in summaries.kept_year_counts(parts).collect()) == sorted(map(tuple, rows.groupBy(year).count().collect()))
    assert [r.n for r in summaries.kept_top_cwe(parts, 3).collect()] == [273, 273, 273]
    found = summaries.kept_estimates(parts).first()
    assert abs(found.sources - 700) < 35 and abs(found.score_50 - 5.0) < 0.5 and abs(found.score_90 - 9.0) < 0.5
    none = summaries.partial_summary(rows.select("id").withColumn("cvss", F.lit(None).cast("double")))
    assert summaries.kept_estimates(none).first().score_50 is None


def test_all_tables_change_together(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "state")
    old = {name: spark.createDataFrame([(name, 1)], "id string, n int") for name in ("cves", "exploits", "writeups")}
    new = {name: spark.createDataFrame([(name, 2), ("more", 2)], "id string, n int") for name in ("cves", "exploits")}
    assert read_together(spark, root) == {}
    assert writers.publish_together(spark, root, old, {"cves": "id"}) == {"cves": 1, "exploits": 1, "writeups": 1}
    before = read_together(spark, root)
    with monkeypatch.context() as patched:
        seen, write = [], writers.counted_write

        def halting(df, run):
            seen.append(1)
            if len(seen) == 2:
                raise RuntimeError("stopped")
            return write(df, run)

        patched.setattr(writers, "counted_write", halting)
        with pytest.raises(RuntimeError, match="stopped"):
            writers.publish_together(spark, root, new)
    assert {name: df.first().n for name, df in read_together(spark, root).items()} == dict.fromkeys(old, 1)
    writers.publish_together(spark, root, new)
    assert {name: df.first().n for name, df in read_together(spark, root).items()} == {"cves": 2, "exploits": 2, "writeups": 1}
    assert before["cves"].first().n == 1 and manifest.read_state(spark, root)[0] == 2


def test_latest_rows_in_any_order_of_deliveries(spark, tmp_path):
    rng = random.Random(5)
    rows = [(f"K{rng.randint(0, 15)}" if rng.random() < 0.97 else None, rng.choice([None, "2024-01-01", "2024-02-01", "2024-03-01"]), f"row {k}") for k in range(120)]
    found = []
    for seed in (1, 2):
        landing, target, checkpoint = (str(tmp_path / f"{name}{seed}") for name in ("landing", "target", "checkpoint"))
        order = random.Random(seed).sample(rows, len(rows))
        for part in (order[:50], order[50:60], order[40:], order[:5]):
            spark.createDataFrame(part, "id string, last_modified string, text string").write.mode("append").parquet(landing)
            ingest_latest(spark.readStream.schema("id string, last_modified string, text string").parquet(landing), target, checkpoint)
        found.append({r.id: (r.last_modified, r.text) for r in latest_state(spark, target).collect()})
        assert latest_state(spark, target).count() == len(found[-1])
    assert found[0] == found[1] and None not in found[0]
    for key, (modified, _) in found[0].items():
        assert (modified or "") == max(m or "" for k, m, _ in rows if k == key)
