"""Sampled segmentations: exact probabilities, reproducible draws, lossless decoding."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vulnatlas.llm import sentencepiece_sampling as S
from vulnatlas.llm.queries import QUERIES


@pytest.fixture(scope="module")
def pieces():
    return S.Pieces(S.default_model())


def paths(word, pieces):
    """Every segmentation of a word with its weight, by trying all cuts."""
    name = {pieces.pieces[k]: (int(k), float(w)) for k, w in zip(pieces.ids, pieces.weights[:-1], strict=True)}

    def cut(rest):
        if not rest:
            yield (), 0.0
            return
        for n in range(1, min(len(rest), pieces.longest) + 1):
            if rest[:n] in name:
                k, w = name[rest[:n]]
                yield from (((k, *more), w + score) for more, score in cut(rest[n:]))
        if rest[0] not in name:
            raw = rest[0].encode()
            yield from (((*(int(pieces.byte_ids[b]) for b in raw), *more), pieces.byte_weight * len(raw) + score) for more, score in cut(rest[1:]))

    return {ids: math.exp(score) for ids, score in cut(S.MARK + word)}


@pytest.mark.parametrize("word", ["the", "token", "aé", "x\nab", "日x"])
def test_draws_follow_the_lattice(pieces, word):
    weights = paths(word, pieces)
    total, n = sum(weights.values()), 20_000
    seen = Counter(tuple(f.tolist()) for f in S.encode([word] * n, np.arange(n, dtype=np.uint64), pieces))
    assert set(seen) <= set(weights)
    for ids, weight in weights.items():
        p = weight / total
        assert abs(seen[ids] / n - p) <= 5 * math.sqrt(p * (1 - p) / n) + 1e-9


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8"), max_size=30) | st.text("ab ▁\n", max_size=12), max_size=5))
def test_decoding_is_lossless(pieces, texts):
    found = S.encode(texts, np.arange(len(texts), dtype=np.uint64), pieces)
    assert [S.decode(ids, pieces) for ids in found] == texts


def test_draws_do_not_depend_on_what_lies_beside(pieces):
    texts = ["several words of one ordinary text, " * 40, "and some others", "x" * 3000, ""]
    keys = np.array([5, 6, 7, 8], np.uint64)
    together = S.encode(texts, keys, pieces)
    for k, text in enumerate(texts):
        assert np.array_equal(S.encode([text], keys[k:k + 1], pieces)[0], together[k])
    assert not np.array_equal(S.encode(texts[:1], keys[1:2], pieces)[0], together[0])


def test_awkward_rows(spark, awkward):
    once, again = (sorted((tuple(r) for r in S.encoded(df).collect()), key=repr) for df in (awkward, awkward.repartition(7)))
    assert once == again and len(once) == awkward.count() and all(r[-1] for r in once)
    assert {r[:2] for r in once if r[1] == 0} == {(2, 0), (3, 0), (None, 0)}
    assert S.encoded(awkward.limit(0), ids=False).collect() == []


def test_the_query_returns_the_sampled_pieces(spark, pieces, tmp_path):
    rows = [(1, "several words  of one text"), (2, None), (3, "日本 é\n"), (3, ""), (None, "x")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["op2_sentencepiece_sampling"](spark, str(tmp_path)).collect()
    assert sorted(((r.doc_id or 0, S.decode(np.array(r.ids, np.int64), pieces)) for r in found)) == sorted((i or 0, t or "") for i, t in rows)
    assert all(len(r.ids) == r.n_pieces and r.lossless for r in found)


def test_slices_are_bounded(spark, monkeypatch):
    """What a worker cuts at a time stays small: in the pipeline it shares the executor with the stages before it."""
    encode = S.encode

    def watched(texts, *more):
        if sum(map(len, texts)) > 2_000_000:
            raise ValueError(f"{sum(map(len, texts))} characters at a time")
        return encode(texts, *more)

    monkeypatch.setattr(S, "encode", watched)
    docs = spark.createDataFrame([(k, "some words of a text " * 5_000) for k in range(30)], "doc_id long, text string").coalesce(1)
    assert all(r.lossless for r in S.encoded(docs, ids=False).collect())
