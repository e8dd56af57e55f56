"""Near duplicates against brute force over all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vulnatlas.llm import minhash_dedup as M
from vulnatlas.llm.components import connected_components
from vulnatlas.llm.text import stored


def brute(rows, width, percent):
    """``doc_id -> component`` by comparing every pair of sets."""
    sets = {i: M.text_shingles((t or "").encode(), width) if (t or "").split() else set() for i, t in rows}
    group = {i: i for i in sets}

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for a in sets:
        for b in sets:
            shared = len(sets[a] & sets[b])
            if a < b and shared and 100 * shared >= percent * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                group[y] = x
    return {i: top(i) for i in sets}, {i: len(s) for i, s in sets.items()}


def texts(seed, groups, copies, changes):
    """Groups of near copies: some words of a text replaced, so that similarities lie around the threshold."""
    rng = random.Random(seed)
    out = []
    for _ in range(groups):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(20, 80))]
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randrange(changes + 1)):
                text[rng.randrange(len(text))] = f"x{rng.randrange(10**6)}"
            out.append(" ".join(text))
    rng.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("groups, copies, changes, small", [(25, 8, 6, 32), (2, 90, 9, 4)])
def test_components_equal_brute_force(spark, monkeypatch, groups, copies, changes, small):
    monkeypatch.setattr(M, "SMALL", small)  # the second case joins large buckets by prefixes
    rows = texts(3, groups, copies, changes)
    component, size = brute(rows, 2, 80)
    found = M.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()
    assert {r.doc_id: (r.component_id, r.n_shingles, r.kept) for r in found} == {
        i: (component[i], size[i], component[i] == i) for i, _ in rows}


def test_ids_that_are_not_broadcast_give_the_same(spark, monkeypatch):
    rows = texts(5, 6, 6, 5)
    monkeypatch.setattr(M, "BROADCAST_IDS", 0)
    component, _ = brute(rows, 5, 80)
    found = M.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in found} == component


def test_awkward_rows(spark, awkward):
    found = M.near_duplicates(awkward).collect()
    assert len(found) == awkward.count()
    got = {(r.doc_id, r.component_id, r.kept) for r in found}
    assert got == {(1, 1, True), (2, 2, True), (3, 3, True), (4, 4, True), (5, 5, True), (6, 5, False), (7, 1, False),
                   (None, None, True), (8, 8, True)}
    kept = M.drop_near_duplicates(awkward)
    # Copies go whether their id repeats, is null, or neither; rows without words stay.
    assert kept.columns == awkward.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 8]
    assert M.near_duplicates(awkward.limit(0)).collect() == [] and M.drop_near_duplicates(awkward.limit(0)).collect() == []


def test_rows_that_repeat_an_id_are_judged_by_their_own_words(spark):
    text = [" ".join(f"{name}{k}" for k in range(40)) for name in "abcd"]
    rows = [(1, text[0]), (3, text[1]), (3, text[0]), (4, text[2]), (4, text[2]), (None, text[3]), (None, text[3]), (5, text[1] + " x"), (9, text[3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS row_key", "2 AS `group`", "3 AS id", "4 AS _row_key")
    kept = M.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted([(1, text[0]), (3, text[1]), (4, text[2]), (9, text[3])])


def test_pruning_keeps_nearly_every_similar_pair():
    """At the threshold itself, a pair survives all looks but with a small probability."""
    needed, rng = M.least_matches(0.8, M.MISS), np.random.default_rng(1)
    equal = rng.random((20_000, M.HASHES)) < 0.8
    alive = np.ones(len(equal), bool)
    for n, least in needed.items():
        alive &= equal[:, :n].sum(axis=1) >= least
    assert alive.mean() > 0.999
    far = (rng.random((2000, M.HASHES)) < 0.3)[:, :16].sum(axis=1) >= needed[16]
    assert far.mean() < 0.9 and list(needed) == list(range(M.BATCH, M.HASHES + 1, M.BATCH))


def test_chains_and_empty_links(spark):
    chain = [(k, k + 1) for k in range(60)] + [(100, 101), (101, 100), (7, 7)]
    found = dict(tuple(r) for r in connected_components(spark.createDataFrame(chain, "a long, b long")).collect())
    assert found == {k: 0 for k in range(61)} | {100: 100, 101: 100}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_copies_of_one_text_meet_it_and_not_each_other(spark, monkeypatch):
    """Copies that are linked by their original alone are not compared pair by pair, wherever it stands."""
    n, base = 100, [f"w{k}" for k in range(150)]
    places = [(7 + 13 * k % 40, 55 + 7 * k % 41, 103 + 11 * k % 42) for k in range(n)]
    copies = [(k, " ".join(f"c{k}x{j}" if j in places[k] else w for j, w in enumerate(base))) for k in range(n)]
    docs = spark.createDataFrame([*copies, (n, " ".join(base)), (n + 1, "quite another text of more than five words")], "doc_id long, text string")
    counts = []

    def counted(df, name, *args, **kwargs):
        table = stored(df, name, *args, **kwargs)
        if name == "pairs":
            counts.append(table.count())
        return table

    monkeypatch.setattr(M, "stored", counted)
    found = {r.doc_id: r.component_id for r in M.near_duplicates(docs).collect()}
    assert found == {k: 0 for k in range(n + 1)} | {n + 1: n + 1}
    assert sum(counts) < 10 * n


def test_rows_go_without_a_shuffle_of_texts(spark, plan):
    text = "one two three four five six seven"
    docs = spark.createDataFrame([(k, text if k % 3 else f"{text} {k} {k} {k} {k}") for k in range(30)], "doc_id long, text string")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = M.drop_near_duplicates(docs)
        assert "Exchange hashpartitioning" not in plan(kept)
        assert sorted(r.doc_id for r in kept.collect()) == [k for k in range(30) if k % 3 == 0 or k == 1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


@pytest.mark.parametrize("limit", [0, 16_000])
def test_rows_that_go_are_found_by_their_bits(spark, monkeypatch, limit):
    monkeypatch.setattr(M, "BROADCAST_BITMAPS", limit)
    rows = spark.range(0, 200_000, 1, 3).select(F.monotonically_increasing_id().alias("row_key"), "id", F.lit(1).alias("KEY_BITS"))
    goes = "id % 7 = 3 OR id IN (0, 32767, 32768, 32769, 65536, 199999)"
    left = M._without(rows, rows.filter(goes).select("row_key"), "row_key").select(rows.columns)
    want = rows.filter(f"NOT ({goes})")
    assert left.count() == want.count() and left.exceptAll(want).isEmpty()
    assert M._without(rows, rows.limit(0).select("row_key"), "row_key").count() == 200_000
