"""Line-delimited JSON, enrichment datasets and search over tables of any shape."""

from __future__ import annotations

import base64
import json

import pytest
from pyspark.sql import functions as F

from vulnatlas.functions import columns as C
from vulnatlas.operators import enrichment
from vulnatlas.operators.normalize import advisories_from_index
from vulnatlas.sinks import writers
from vulnatlas.sources import jsonl, tables


def test_index_skips_bad_lines_and_requires_ids(spark, tmp_path):
    path = tmp_path / "cve_index.jsonl"
    good = {"id": "CVE-1", "cvssScore": 5, "references": ["u"], "description": "é", "published": "2020-01-01"}
    path.write_text("\n".join([json.dumps(good), '{"id": "CVE-2", ', "not json", '{"id": "CVE-3", "cvssScore": "high"}']))
    table = {r.id: r for r in advisories_from_index(jsonl.read_index(spark, str(path), jsonl.ADVISORY_INDEX)).collect()}
    assert sorted(table) == ["CVE-1", "CVE-3"]
    assert (table["CVE-1"].cvss, table["CVE-1"].refs, table["CVE-1"].ref_tags, table["CVE-1"].year) == (5.0, ["u"], [], 2020)
    assert table["CVE-3"].cvss is None
    path.write_text('{"description": "no id"}\n')
    with pytest.raises(Exception, match="without id"):
        jsonl.read_index(spark, str(path), jsonl.ADVISORY_INDEX).count()


def test_any_jsonl_takes_the_union_of_keys(spark, tmp_path):
    (tmp_path / "d.jsonl").write_text('{"b": 1, "a": {"x": null}}\n{"c": [1, 2], "b": "s"}\n{"d": true}\n')
    df = jsonl.read_any(spark, str(tmp_path / "d.jsonl"))
    assert df.columns == ["a", "b", "c", "d"] and df.schema["b"].dataType.simpleString() == "string"
    text = enrichment.text_view(df).collect()
    assert (text[0].a, text[0].b, text[1].c, text[2].d) == ('{"x":null}', "1", "[1,2]", "true")


def test_sidecars_name_the_tables(spark, tmp_path):
    directory = str(tmp_path / "hf")
    scores = spark.createDataFrame([("CVE-1", 9.8), ("CVE-2", None)], "id string, score double")
    assert writers.land_enrichment(scores, "some/vuln-scores", directory, "hf_vuln_scores") == 2
    assert writers.land_enrichment(scores, "some/other-set", directory) == 2
    (tmp_path / "hf" / "lost_meta.json").write_text('{"table": "hf_lost"}')
    (tmp_path / "hf" / "untold_meta.json").write_text('{"dataset": "x"}')
    (tmp_path / "hf" / "untold.jsonl").write_text('{"a": 1}\n')
    found = tables.discover_enrichment(spark, directory)
    assert sorted(found) == ["hf_some__other_set", "hf_vuln_scores"]
    assert found["hf_vuln_scores"].orderBy("id").collect()[0][:] == ("CVE-1", 9.8)
    sidecar = json.loads((tmp_path / "hf" / "some__vuln-scores_meta.json").read_text())
    assert sidecar["rows"] == 2 and sidecar["dataset"] == "some/vuln-scores" and sidecar["split"] == "train"


def test_safe_columns(spark):
    df = spark.createDataFrame([(1, 2)], ["a b", "c"])
    assert tables.with_safe_columns(df).columns == ["a_b", "c"]
    with pytest.raises(ValueError, match="clash"):
        tables.with_safe_columns(df.toDF("a b", "a-b"))


def test_sidecars_keep_long_names_and_refuse_clashes(spark, tmp_path):
    rows = spark.createDataFrame([(1,)], "a int")
    for directory, names in (("long", ["hf_" + "x" * 70 + end for end in ("one", "two")]), ("clash", ["hf_a-b", "hf_a_b"])):
        for k, name in enumerate(names):
            writers.land_enrichment(rows, f"own/{k}", str(tmp_path / directory), name)
    assert len(tables.discover_enrichment(spark, str(tmp_path / "long"))) == 2
    with pytest.raises(ValueError, match="clash"):
        tables.discover_enrichment(spark, str(tmp_path / "clash"))


def test_patches_as_json_text(spark):
    text = '[{"url": "u", "patch_text_b64": "' + base64.b64encode(b"+ strcpy").decode() + '"}]'
    patches = spark.createDataFrame([("P", "t", "c", text), ("Q", "t", "c", "not json")], "id string, title string, cwe string, patches string")
    assert [(r.id, r.n, r.url, r.diff) for r in enrichment.decoded_patches(patches).collect()] == [("P", 0, "u", "+ strcpy")]


def test_shards_merge_their_columns(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "s" / "p1"))
    spark.range(3).withColumn("x", F.lit("v")).write.parquet(str(tmp_path / "s" / "p2"))
    merged = tables.read_shards(spark, str(tmp_path / "s"))
    assert sorted(merged.columns) == ["id", "x"] and merged.count() == 5
    assert tables.read_shards(spark, str(tmp_path / "s"), limit=1).count() == 1


def test_search_over_tables(spark):
    one = spark.createDataFrame([("1", "Nginx 50%"), ("2", "nginx"), ("3", "apache")], "id string, title string")
    other = spark.createDataFrame([(1, "x", "nginx"), (2, "y", "z")], "a int, b string, c string")
    far = spark.createDataFrame([(1, 2, 3, "nginx")], "a int, b int, c int, d string")
    found = enrichment.search_tables({"hf_one": one, "hf_other": other, "hf_far": far}, "NGINX", limit=1)
    assert sorted((r.table, r.id or int(r.a)) for r in found.collect()) == [("hf_far", 1), ("hf_one", "1"), ("hf_other", 1)]
    counts = enrichment.match_counts(enrichment.search_tables({"hf_one": one, "hf_other": other}, "nginx"))
    assert {r.table: r.n for r in counts.collect()} == {"hf_one": 2, "hf_other": 1}
    assert enrichment.search_tables({"hf_one": one}, "0%").count() == 1
    assert enrichment.search_tables({"hf_one": one}, "_").count() == 0


@pytest.fixture(scope="module")
def patches(spark):
    def encode(text):
        return base64.b64encode(text).decode()

    rows = [
        ("P-1", "Fix overflow", [("u1", encode(b"- strcpy(a, b)")), ("u2", "%%%"), ("u3", encode(b"\xff\xfe"))], ["CWE-120"]),
        ("P-2", None, [("u4", encode("größe".encode()))], ["CWE-79"]),
        ("P-3", "none", [], []),
    ]
    return spark.createDataFrame(
        rows, "id string, title string, patches array<struct<url string, patch_text_b64 string>>, cwe array<string>")


def test_patch_search(patches):
    diffs = {(r.id, r.n): r.diff for r in enrichment.decoded_patches(patches).collect()}
    assert diffs == {("P-1", 0): "- strcpy(a, b)", ("P-1", 1): None, ("P-1", 2): None, ("P-2", 0): "größe"}
    assert [r.id for r in enrichment.patch_search(patches, "cwe-79").collect()] == ["P-2"]
    assert [r.id for r in enrichment.patch_search(patches, "overflow").collect()] == ["P-1"]
    assert enrichment.patch_search(patches, "strcpy").count() == 0
    assert [r.url for r in enrichment.decoded_patch_search(patches, "STRCPY").collect()] == ["u1"]


def test_json_columns(spark):
    rows = spark.createDataFrame([('["a", "b"]',), ("",), (None,), ("not json",)], "cwe string")
    arrays = [r.a for r in rows.limit(3).select(C.json_array(F.col("cwe")).alias("a")).collect()]
    assert arrays == [["a", "b"], [], []]
    parsed = enrichment.with_parsed_json(rows, "cwe").select("cwe", F.col("cwe_json").isNotNull().alias("ok"))
    assert [r.ok for r in parsed.collect()] == [True, False, False, False]


def test_result_lines_write_nulls(spark):
    df = spark.createDataFrame([("é", None, [1])], "a string, b string, c array<int>")
    assert writers.result_lines(df).first().line == '{"a":"é","b":null,"c":[1]}'
