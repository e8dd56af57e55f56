"""The pipeline's stages against brute force on each stage's own input, and the registered queries against their SQL."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from check import rows as comparable
from tests.llm.test_minhash_dedup import brute as components
from tests.llm.test_substring_dedup import brute as repeats
from vulnatlas.llm import toxicity
from vulnatlas.llm.queries import ORACLES, QUERIES
from vulnatlas.llm.text import stored

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def passed(spark):
    """What each stage got, by its name, and the last one's result."""
    docs, out = spark.read.parquet(f"{SF_DIR}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out[name] = docs
        docs = stored(stage(spark, docs, SF_DIR), name)
    return out | {"end": docs}


def pairs(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_keep_the_columns(spark, passed):
    schema = spark.read.parquet(f"{SF_DIR}/documents.parquet").columns
    assert all(df.columns == schema for name, df in passed.items() if name != "end")
    assert [n for n, _ in corpus_pipeline.STAGES] == list(passed)[:-1] and corpus_pipeline.ORACLE_SQL is None


def test_toxic_texts_go(spark, passed):
    model = toxicity.trained(passed["toxicity"], spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    scores = toxicity.toxicity_scores(passed["toxicity"], model).filter("score < 0.5")
    assert {r.doc_id for r in scores.collect()} == set(pairs(passed["near_dedup"]))


def test_one_of_each_group_stays(passed):
    component, _ = components(sorted(pairs(passed["near_dedup"]).items()), 5, 80)
    assert set(pairs(passed["substring_dedup"])) == {i for i, c in component.items() if i == c}


def test_repeated_passages_go(spark, passed):
    want = repeats(sorted(pairs(passed["substring_dedup"]).items()), 13)
    before, after = pairs(passed["substring_dedup"]), pairs(passed["decontamination"])
    assert set(after) == set(before)
    for i, text in after.items():
        n, gone, _ = want[i]
        assert len(text.split()) == n - gone and (gone or text == before[i])
    assert {r.doc_id: r.n_chars for r in passed["decontamination"].collect()} == {i: len(t) for i, t in after.items()}


def test_benchmark_goes(spark, passed):
    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    before, after = pairs(passed["decontamination"]), pairs(passed["pieces"])
    whole = {i for i, t in before.items() if any(b in " ".join(t.lower().split()) for b in items)}
    assert not whole & set(after) and len(before) - len(after) <= len(whole) + 2


def test_pieces_are_lossless(passed):
    rows = passed["end"].collect()
    assert {r.doc_id for r in rows} == set(pairs(passed["pieces"])) and all(r.lossless and len(r.ids) == r.n_pieces for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_equal_their_sql(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    got = comparable(df.columns, df.collect())
    assert got[1]
    if name in ORACLES:
        con = duckdb.connect()
        for file in Path(SF_DIR).glob("*.parquet"):
            con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
        result = con.execute(ORACLES[name])
        assert got == comparable([c[0] for c in result.description], result.fetchall())


CLASHING = ("_changed", "_gone", "_ranges", "row", "row_key", "ranges", "own_id", "own_mark", "group", "number", "mark")


def write_tables(spark, folder, docs, labels, benchmark):
    docs = spark.createDataFrame(docs, "doc_id long, text string").selectExpr(
        "*", "'en' AS lang", "'s' AS source", "CAST(length(text) AS BIGINT) AS n_chars", *(f"{k} AS `{name}`" for k, name in enumerate(CLASHING)))
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(benchmark, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return docs


def test_awkward_documents_pass_all_stages(spark, tmp_path):
    """Ids that repeat or lack, null, empty and very long texts, names that clash: each row is judged by its own text."""
    unique = [" ".join(f"{name}{k}" for k in range(40)) for name in "abcdefg"]
    long = " ".join(f"w{k % 977}x{k % 31}" for k in range(30_000))
    item = " ".join(f"q{k}" for k in range(30))
    docs = [
        (1, unique[0]), (3, unique[1]), (3, unique[0]), (4, unique[2]), (4, unique[2]), (None, unique[3]), (None, None), (5, ""), (6, " \t"), (7, None),
        (8, long), (9, long), (10, f"{unique[4]} {item}"), (11, f"{unique[5]} {unique[6]}"), (12, f"{unique[6]} {unique[4]} tail")]
    labels = [(1, 1, 0), (None, 1, 1), (77, 0, 1), (3, None, None)]
    write_tables(spark, tmp_path, docs, labels, [(1, item), (2, None), (None, "x y z"), (3, "")])
    rows = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stored(stage(spark, rows, str(tmp_path)), name)
        assert after.columns == rows.columns and after.schema["n_chars"].dataType == rows.schema["n_chars"].dataType
        assert all(r[column] == k for r in after.collect() for k, column in enumerate(CLASHING))
        rows = after
    kept = sorted(((r.doc_id or 0, r.text) for r in rows.collect()), key=repr)
    assert kept == sorted([
        (1, unique[0]), (3, unique[1]), (4, unique[2]), (0, unique[3]), (0, None), (5, ""), (6, " \t"), (7, None), (8, long),
        (11, f"{unique[5]} {unique[6]}"), (12, "tail")], key=repr)
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.iterdir())
    result = corpus_pipeline.run(spark, str(tmp_path))
    assert [path.name.rpartition("-")[0] for path in set(shared.iterdir()) - before] == ["pieces"]
    ended = result.collect()
    assert sorted(r.doc_id or 0 for r in ended) == sorted(i for i, _ in kept) and all(r.lossless for r in ended)


@pytest.mark.parametrize("empty", ["documents", "labels", "benchmark"])
def test_empty_tables(spark, tmp_path, empty):
    docs = [] if empty == "documents" else [(1, "one two three four five six"), (2, "seven eight nine ten eleven twelve")]
    write_tables(spark, tmp_path, docs, [] if empty == "labels" else [(1, 1, 0), (2, 0, 1)], [] if empty == "benchmark" else [(1, "a b c d e f g")])
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert len(found) <= len(docs) and (empty != "labels" or len(found) == 2)
