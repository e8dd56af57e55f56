"""Idempotent ingest, key checks and publishing."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vulnatlas.operators import merging
from vulnatlas.plans import pipeline, queries, stats
from vulnatlas.session import path_exists, shared_path, staged
from vulnatlas.sinks import writers
from vulnatlas.sources import tables


@pytest.fixture(scope="module", autouse=True)
def no_tables_left(spark):
    yield
    for table in spark.catalog.listTables():
        spark.sql(f"DROP TABLE IF EXISTS {table.name}")


def frame(spark, *items, columns="id string, n int"):
    return spark.createDataFrame(list(items), columns)


def test_append_new_twice_is_append_new_once(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    batch = frame(spark, ("a", 2), ("a", 1), ("b", 5))
    assert writers.append_new(batch, path, "id", "n") == 2
    assert writers.append_new(batch, path, "id", "n") == 0
    assert writers.append_new(frame(spark, ("a", 0), ("c", 1)), path, "id", "n") == 1
    assert rows(spark.read.parquet(path)) == [("a", 1), ("b", 5), ("c", 1)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 50)), min_size=1, unique=True))
def test_one_per_key_keeps_the_first(spark, items):
    got = dict(map(tuple, merging.one_per_key(frame(spark, *items), "id", "n").collect()))
    assert got == {key: min(n for k, n in items if k == key) for key, _ in items}


def test_copies_are_dropped_before_the_shuffle(spark, plan):
    """A key with very many copies sends one row per task, and the anti-join adds no shuffle."""
    incoming = spark.range(0, 100_000, 1, 8).select(F.concat(F.lit("k"), F.col("id") % 3).alias("id"), F.col("id").alias("n"))
    physical = plan(merging.new_rows(incoming, frame(spark, ("x", 1)), "id", "n")).split("== Physical Plan ==")[1]
    left = physical.split("Scan ExistingRDD")[0]
    above, below = left.split("Exchange hashpartitioning(id", 1)
    assert above.count("WindowGroupLimit") == below.count("WindowGroupLimit") == 1


def test_latest_and_upsert(spark, rows):
    old = frame(spark, ("a", "2020", "old"), ("b", "2021", "old"), columns="id string, m string, v string")
    new = frame(spark, ("a", "2021", "new"), ("b", "2021", "new"), ("c", None, "new"), columns="id string, m string, v string")
    assert rows(merging.latest_rows(old, new, "id", "m")) == [("a", "2021", "new"), ("b", "2021", "old"), ("c", None, "new")]
    upserted = merging.upsert(frame(spark, ("a", 1), ("a", 2), ("b", 3)), frame(spark, ("a", 9), ("c", 4)), "id")
    assert rows(upserted) == [("a", 9), ("b", 3), ("c", 4)]


def test_duplicates_fail_with_the_key(spark):
    with pytest.raises(ValueError, match=r"duplicate id: a \(2 rows\)"):
        merging.require_unique(frame(spark, ("a", 1), ("a", 2), ("b", 1)), "id")


def test_publish_and_read_back(spark, tmp_path, rows):
    cves = spark.range(1000).select(F.format_string("CVE-%04d", "id").alias("id"), F.col("id").alias("n"))
    counts = writers.publish({"cves": cves, "hf_vuln_scores": cves, "unknown": cves}, str(tmp_path), {"scores": 15})
    assert counts == {"cves": 1000, "scores": 1000}
    assert len(list((tmp_path / "scores" / "train").glob("*.zstd.parquet"))) == 15
    assert rows(tables.read_published(spark, str(tmp_path), "scores")) == rows(cves)


def test_replace_leaves_other_tables(spark):
    writers.replace_table(frame(spark, ("a", 1)), "hf_kept")
    writers.replace_table(frame(spark, ("a", 1)), "base", "id")
    assert writers.replace_table(frame(spark, ("b", 2), ("c", 3)), "base", "id").count() == 2
    assert list(tables.existing_tables(spark, ["base", "hf_kept", "absent"])) == ["base", "hf_kept"]
    assert tables.enrichment_tables(spark) == ["hf_kept"]


def test_replace_checks_the_key_first(spark, rows):
    writers.replace_table(frame(spark, ("a", 1)), "checked", "id")
    with pytest.raises(ValueError, match="duplicate id"):
        writers.replace_table(frame(spark, ("b", 1), ("b", 2)), "checked", "id")
    assert rows(spark.table("checked")) == [("a", 1)]


def test_upsert_table(spark, rows):
    writers.upsert_table(frame(spark, ("a", 1), ("b", 2)), "link_map", "id")
    assert rows(writers.upsert_table(frame(spark, ("b", 3), ("c", 4)), "link_map", "id")) == [("a", 1), ("b", 3), ("c", 4)]
    assert not spark.catalog.tableExists("link_map_merged")


def test_upsert_stores_a_repeated_key_once(spark, rows):
    assert rows(writers.upsert_table(frame(spark, ("a", 2), ("a", 1)), "once", "id")) == [("a", 1)]


@pytest.mark.parametrize("statement, nth", [
    ("halted RENAME TO default.vulnatlas_swap_old__halted", 1),
    ("vulnatlas_swap_new__halted RENAME TO default.halted", 1),
    ("DROP TABLE default.vulnatlas_swap_old__halted", 1),
])
def test_a_stopped_swap_loses_nothing(spark, rows, monkeypatch, statement, nth):
    writers.replace_table(frame(spark, ("a", 1), ("b", 2)), "halted")
    run, seen = type(spark).sql, []

    def halting(self, text, *args, **more):
        if statement in text:
            seen.append(text)
            if len(seen) == nth:
                raise RuntimeError("stopped")
        return run(self, text, *args, **more)

    with monkeypatch.context() as patched:
        patched.setattr(type(spark), "sql", halting)
        with pytest.raises(RuntimeError, match="stopped"):
            writers.upsert_table(frame(spark, ("b", 3)), "halted", "id")
    assert rows(writers.upsert_table(frame(spark, ("c", 4)), "halted", "id"))[0] == ("a", 1)
    assert rows(spark.table("halted"))[-1] == ("c", 4) and spark.table("halted").count() == 3
    assert not any(spark.catalog.tableExists(f"vulnatlas_swap_{end}__halted") for end in ("new", "old"))


def test_a_swap_drops_no_other_table(spark, rows):
    for name in ("hf_own__new", "hf_own__old"):
        writers.replace_table(frame(spark, ("kept", 1)), name)
    writers.upsert_table(frame(spark, ("a", 1)), "hf_own", "id")
    writers.upsert_table(frame(spark, ("b", 1)), "hf_own", "id")
    assert [rows(spark.table(f"hf_own{end}")) for end in ("", "__new", "__old")] == [[("a", 1), ("b", 1)], [("kept", 1)], [("kept", 1)]]
    with pytest.raises(ValueError, match="must not begin"):
        writers.replace_table(frame(spark, ("a", 1)), "vulnatlas_swap_new__hf_own")
    frame(spark, ("a", 1)).write.saveAsTable("vulnatlas_swap_old__foreign")
    with pytest.raises(ValueError, match="belongs to something else"):
        writers.replace_table(frame(spark, ("a", 1)), "foreign")
    assert rows(spark.table("vulnatlas_swap_old__foreign")) == [("a", 1)]
    spark.sql("DROP TABLE vulnatlas_swap_old__foreign")


def test_a_view_of_the_same_name_is_not_the_table(spark, rows):
    writers.replace_table(frame(spark, ("a", 1)), "shadowed")
    queries.register_views({"shadowed": frame(spark, ("a", 1))})
    try:
        assert rows(writers.replace_table(frame(spark, ("a", 2)), "shadowed")) == [("a", 2)]
        assert rows(writers.upsert_table(frame(spark, ("b", 1)), "shadowed", "id")) == [("a", 2), ("b", 1)]
    finally:
        spark.catalog.dropTempView("shadowed")


def test_appends_write_few_files_and_need_no_order(spark, tmp_path):
    path = str(tmp_path / "few")
    batch = spark.range(1000).repartition(16).selectExpr("CAST(id AS STRING) AS id", "CAST(id % 5 AS INT) AS year")
    assert writers.append_new(batch, path, "id", partition_by="year") == 1000
    assert all(len(list(p.glob("*.parquet"))) <= 2 for p in (tmp_path / "few").glob("year=*"))
    assert writers.append_new(batch, path, "id", partition_by="year") == 0


def test_staged_rows_are_removed(spark, rows):
    with staged(frame(spark, ("a", 1)), "x") as stored:
        path = stored.inputFiles()[0]
        assert rows(stored) == [("a", 1)] and path_exists(spark, path)
    assert not path_exists(spark, path)


def test_build_keeps_what_it_is_not_given(spark, tmp_path):
    root = tmp_path / "writeups"
    root.mkdir()
    (root / "a.md").write_text("# A")
    built = pipeline.build(spark, str(tmp_path / "p"), writeup_root=str(root))
    assert list(built) == ["writeups"] and built["writeups"].first().title == "A"
    assert spark.catalog.tableExists("hf_kept")


def test_year_counts_accumulate(spark, rows):
    cves = frame(spark, ("2020-01-01",), ("2020-02-01",), ("2021-01-01",), columns="published string")
    assert rows(stats.year_counts(cves)) == [("2020", 2, 2), ("2021", 1, 3)]


def test_shared_path_follows_the_session(spark):
    assert shared_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shared_path(spark, "x") != shared_path(spark, "x")
