"""Postings of all tokens, by slices of rows, against the folding and stemming of single texts; segments folded block by block."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from vulnatlas.functions.text import tokens
from vulnatlas.operators import postings, segments
from vulnatlas.operators.postings import build_postings, query_tokens
from vulnatlas.operators.segments import append_segment, merge_segments, open_index

TEXTS = [
    "Executing executed code, the CODE executes", "", None, "naïve Café ́ état à́ ́̂ end", "a̱b ̀c ΑΣ İstanbul",
    "x" * 80 + " 日本 日本 straße", "one", "... !", " ".join(f"w{k % 13}ing" for k in range(300)),
]


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(k % 7 if k % 5 else None, f"T-{k % 4}", text, k) for k, text in enumerate(TEXTS * 3)]
    return spark.createDataFrame(rows, "id long, title string, description string, block int").repartition(2)


@pytest.mark.parametrize("stem", [False, True])
@pytest.mark.parametrize("words", [7, 500_000])
def test_postings_equal_the_tokens_of_each_text(spark, texts, stem, words, monkeypatch):
    monkeypatch.setattr(postings, "SLICE_WORDS", words)
    want, worded = [], texts.select("*", tokens(F.col("title")).alias("own"), tokens(F.col("description")).alias("words")).collect()
    known = sorted({t for row in worded for t in (*row.own, *row.words)})
    stem_of = dict(zip(known, (t[0] for t in query_tokens(spark, known, True)), strict=True)) if stem else {t: t for t in known}
    for row in worded:
        for field, found in (("title", row.own), ("description", row.words)):
            stems = [stem_of[t] for t in found]
            want += [(row.id, row.block, field, t, [n for n, s in enumerate(stems) if s == t]) for t in set(stems)]
    got = build_postings(texts, fields=("title", "description"), stem=stem, keep=("block",))
    assert [c.name for c in got.schema] == ["id", "block", "field", "token", "positions"] and got.schema["id"].dataType.typeName() == "long"
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(map(repr, want)) != []


def test_an_append_deals_out_texts_and_moves_no_posting(spark, tmp_path, monkeypatch):
    """One append and a merge: no posting is staged, dealt out in ranges or shuffled, whatever the order it is found in."""
    plans = []
    sorted_postings = segments._sorted_postings
    monkeypatch.setattr(segments, "_sorted_postings", lambda df, *more: (plans.append(df._jdf.queryExecution().toString()), sorted_postings(df, *more)))
    rows = [(f"CVE-{k}", "apache server code", 0.1 * (k % 101), "2001-01-01", "HIGH", f"CWE-{k % 9}") for k in range(300)]
    df = spark.createDataFrame(rows, "id string, description string, cvss double, published string, severity string, cwe string")
    root = str(tmp_path / "index")
    assert append_segment(spark, df.limit(100), root) == 100 and append_segment(spark, df, root) == 200 and merge_segments(spark, root) == 2
    physical = [plan.split("== Physical Plan ==")[1] for plan in plans]
    assert len(physical) == 3 and all(p.count("Exchange rangepartitioning(block") == 1 for p in physical[:2]) and "Exchange" not in physical[2]
    index = open_index(spark, root)
    assert index.postings.count() == 300 * 5 and {r.token: r.n for r in index.terms().filter("token IN ('server', 'cve')").collect()} == {"server": 300, "cve": 300}
    files = index.postings.select("block", F.input_file_name().alias("f")).distinct().groupBy("block").count().collect()
    assert len(files) == 11 and all(r["count"] == 1 for r in files)
