"""Question functions, their plans, and every registered query against its SQL."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from check import rows as comparable
from vulnatlas.operators import filters, limits
from vulnatlas.plans import driver_tables as D
from vulnatlas.plans import queries as Q
from vulnatlas.plans import stats as S
from vulnatlas.plans.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    df = entry_points.queries()[name](spark, SF_DIR)
    got = comparable(df.columns, df.collect())
    if name in entry_points.oracle_sql():
        result = duck.execute(entry_points.oracle_sql()[name])
        assert got == comparable([c[0] for c in result.description], result.fetchall())


def test_every_oracle_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry_has_rows(spark):
    assert entry_points.entry(spark).count() > 0


@pytest.fixture(scope="module")
def cves(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("cves") / "t")
    D.cves(spark, SF_DIR).selectExpr("*", "CAST(left(published, 4) AS INT) AS year").write.partitionBy("year").parquet(path)
    return spark.read.parquet(path)


def test_filters_reach_the_scan(cves, plan):
    physical = plan(Q.product(cves, "the", severity="high, low", cwe="cwe-79", since=2010, min_cvss=4))
    for pushed in ("In(severity, [HIGH,LOW])", "EqualTo(cwe,CWE-79)", "GreaterThanOrEqual(cvss,4.0)", "year#"):
        assert pushed in physical
    assert "PartitionFilters: [isnotnull(year" in physical and "TakeOrderedAndProject" in physical


def test_a_count_reads_one_column(cves, plan):
    assert "ReadSchema: struct<severity:string>" in plan(S.severity_counts(cves))


def test_lookup(cves):
    wanted = cves.first().id
    wide = cves.selectExpr("*", "array(source) AS refs", "array() AS ref_tags")
    assert [r.id for r in Q.lookup(wide, wanted.lower()).collect()] == [wanted]
    assert Q.lookup(wide, "CVE-0000-0").count() == 0
    assert Q.lookup(wide, wanted).columns[6:8] == ["references", "refTags"]


def test_cwe_modes(spark):
    df = spark.createDataFrame([("CWE-7",), ("CWE-79",), (None,)], "cwe string")
    assert [r.cwe for r in df.filter(filters.cwe_in("cwe-7")).collect()] == ["CWE-7"]
    assert df.filter(filters.cwe_in("cwe-7", exact=False)).count() == 2


def test_contains_is_literal_and_ignores_case(spark):
    df = spark.createDataFrame([("100% ÉTÉ",), ("100 été",), (None,)], "description string")
    assert df.filter(filters.contains("description", "0%")).count() == 1
    assert df.filter(filters.contains("description", "été")).count() == 2


def test_top_scored_breaks_ties_by_id_with_nulls_last(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", None), ("d", 2.0)], "id string, cvss double")
    assert [r.id for r in limits.top_scored(df, 4).collect()] == ["d", "a", "b", "c"]
    assert limits.top_scored(df, None).count() == 4
    assert limits.top_scored(df, 0).count() == 0


def test_free_sql(spark, cves):
    assert Q.sql(spark, {"cves": cves}, "SELECT count(*) AS n FROM cves").first().n == cves.count()
