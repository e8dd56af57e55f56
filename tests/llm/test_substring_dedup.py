"""Repeated windows against brute force."""

from __future__ import annotations

import hashlib
import random

import pytest

from vulnatlas.llm import substring_dedup as S


def brute(rows, width):
    first, out = {}, {}
    for i, t in rows:
        w = (t or "").split()
        for k in range(len(w) - width + 1):
            key = tuple(w[k:k + width])
            first[key] = min(i, first.get(key, i))
    for i, t in rows:
        w = (t or "").split()
        gone = {k + j for k in range(len(w) - width + 1) if first[tuple(w[k:k + width])] < i for j in range(width)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def rows_of(seed):
    rng = random.Random(seed)
    passages = [" ".join(f"p{rng.randrange(50)}" for _ in range(rng.randrange(10, 60))) for _ in range(6)]
    rows = []
    for i in range(120):
        parts = [" ".join(f"{'é' if k % 7 else ''}u{rng.randrange(400)}" for k in range(rng.randrange(30))) for _ in range(2)]
        parts.insert(rng.randrange(3), rng.choice(passages) if rng.random() < 0.8 else "")
        rows.append((i * 3 % 121, rng.choice([" ", "\n", " \t "]).join(parts)))
    return rows


@pytest.mark.parametrize("range_bytes, send_bytes, known", [(128_000_000, 24_000_000, 200_000), (2_000, 3_000, 5)])
def test_equal_to_brute_force(spark, monkeypatch, range_bytes, send_bytes, known):
    """The second case sends small batches, forgets strings and compares buckets in several ranges."""
    monkeypatch.setattr(S, "RANGE_BYTES", range_bytes)
    monkeypatch.setattr(S, "SEND_BYTES", send_bytes)
    monkeypatch.setattr(S, "KNOWN", known)
    monkeypatch.setattr(S, "BROADCAST_BYTES", 0 if known == 5 else 32_000_000)
    rows = rows_of(known)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = S.digest(S.without_repeats(docs)).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in found} == brute(rows, 13)


def test_hot_passage(spark):
    rows = [(i, "a b c d e f g h i j k l m n o p q " + f"tail{i} " * 3) for i in range(300)]
    found = {r.doc_id: r.n_removed for r in S.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {i: 17 if i else 0 for i in range(300)}


def test_awkward_rows(spark, awkward):
    found = {(r.doc_id, r.n_words, r.n_removed) for r in S.without_repeats(awkward).collect()}
    assert found == {(1, 6, 0), (2, 0, 0), (3, 0, 0), (4, 0, 0), (5, 30_000, 0), (6, 30_000, 30_000), (7, 6, 0), (None, 6, 0),
                     (None, 0, 0), (8, 1, 0)}
    kept = S.drop_repeats(awkward)
    assert kept.schema == awkward.schema and kept.count() == awkward.count()
    assert {(r.doc_id, r.text, r.n_chars) for r in kept.filter("doc_id IN (2, 6)").collect()} == {(2, None, None), (6, "", 0)}
    assert S.without_repeats(awkward.limit(0)).collect() == []


def test_rows_that_repeat_an_id_are_cut_by_their_own_words(spark):
    shared, other, third = (" ".join(f"{name}{k}" for k in range(40)) for name in "abc")
    rows = [(1, shared), (2, other), (2, "x " + shared), (2, other), (3, other + " " + third), (3, third)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((r.doc_id, r.n_words, r.n_removed, r.kept) for r in S.without_repeats(docs).collect())
    assert found == sorted([(1, 40, 0, shared), (2, 40, 0, other), (2, 41, 40, "x"), (2, 40, 0, other), (3, 80, 40, third), (3, 40, 0, third)])
    clashing = docs.selectExpr("*", "1 AS _changed", "2 AS ranges", "3 AS own_id", "4 AS mark", "length(text) AS n_chars")
    kept = S.drop_repeats(clashing)
    assert kept.schema == clashing.schema
    assert sorted((r.doc_id, r.text, r._changed, r.n_chars) for r in kept.collect()) == sorted((i, t, 1, len(t)) for i, _, _, t in found)


def test_one_minimiser_in_every_text(spark, monkeypatch):
    """Its bucket is split by the hash of the window, whatever stands beside it."""
    monkeypatch.setattr(S, "BUCKET_BYTES", 400)
    rng = random.Random(4)
    rows = [(i, " ".join(["m m m m"] + [f"r{rng.randrange(12)}" for _ in range(20)] + ["m m m m"] + [f"r{rng.randrange(3)}" for _ in range(15)])) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    buckets = S.buckets_for(docs, 13, 4)
    assert len(buckets.heavy) and buckets.parts.max() > 1
    found = S.digest(S.without_repeats(docs)).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in found} == brute(rows, 13)
