"""Greedy string tiling against a plain version, and documents with whole, reordered and missing passages."""

from __future__ import annotations

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from vulnatlas.llm import decontamination as C

words = st.lists(st.sampled_from([b"a", b"b", b"c", b"d"]), max_size=24)


def longest_first(item, text, least):
    """Tiles by looking for the longest common unmarked run again and again."""
    p, t, lengths = [False] * len(item), [False] * len(text), []
    while True:
        best = (0, 0, 0)
        for a in range(len(item)):
            for b in range(len(text)):
                k = 0
                while a + k < len(item) and b + k < len(text) and item[a + k] == text[b + k] and not p[a + k] and not t[b + k]:
                    k += 1
                best = max(best, (k, -a, -b))
        k, a, b = best[0], -best[1], -best[2]
        if k < least:
            return lengths
        p[a:a + k] = [True] * k
        t[b:b + k] = [True] * k
        lengths.append(k)


@settings(max_examples=300, deadline=None)
@given(words, words, st.integers(1, 5))
def test_tiles_are_valid_and_leave_no_run(item, text, least):
    tiles = C.greedy_tiles(item, text, least)
    p, t = [False] * len(item), [False] * len(text)
    for a, b, k in tiles:
        assert k >= least and item[a:a + k] == text[b:b + k] and not any(p[a:a + k]) and not any(t[b:b + k])
        p[a:a + k] = [True] * k
        t[b:b + k] = [True] * k
    # Nothing of the least length is left that both sides hold unmarked.
    assert not any(
        item[a:a + least] == text[b:b + least] and not any(p[a:a + least]) and not any(t[b:b + least])
        for a in range(len(item) - least + 1) for b in range(len(text) - least + 1))
    if tiles:
        assert max(k for _, _, k in tiles) == longest_first(item, text, least)[0]


def test_long_runs_are_tiled_first():
    item = [b"%d" % k for k in range(200)]
    assert C.greedy_tiles(item, item[100:] + item[:100], 5) == [(0, 100, 100), (100, 0, 100)]


def fixture(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("aeiou") + rng.choice("bdgklmnrst") for _ in range(3))
    items = [(k, ". ".join(" ".join(word() for _ in range(8)).capitalize() for _ in range(4)) + ".") for k in range(20)] + [(20, "Qq ww?")]
    filler = lambda: " ".join(word() for _ in range(60))
    docs, leaked = [], set()
    for k, text in items:
        parts = text.rstrip(".").split(". ")
        rng.shuffle(parts)
        for n, passage in enumerate((text, f" {filler()} ".join(parts), text.upper().replace(" ", "\n"), parts[0])):
            docs.append((len(docs), f"{filler()} {passage} {filler()}"))
            if n < 3 or k == 20:
                leaked.add((len(docs) - 1, k))
    docs += [(len(docs) + n, filler()) for n in range(30)]
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), leaked


def test_whole_and_reordered_passages(spark, monkeypatch):
    docs, items, leaked = fixture(spark)
    found = C.contamination(docs, items).collect()
    assert {(r.doc_id, r.item_id) for r in found if r.contaminated} == leaked and len(found) == docs.count()
    assert {r.doc_id for r in C.drop_contaminated(docs, items).collect()} == {r.doc_id for r in found if not r.contaminated}
    monkeypatch.setattr(C, "BLOCK_BYTES", 500)
    blocks = C.contamination(docs, items).collect()
    assert sorted(map(tuple, blocks)) == sorted(map(tuple, found))
    kept = C.drop_contaminated(docs.selectExpr("*", "1 AS row_key"), items)
    assert kept.columns == ["doc_id", "text", "row_key"] and {r.doc_id for r in kept.collect()} == {r.doc_id for r in found if not r.contaminated}


def test_a_benchmark_of_any_size_gives_the_same_awkward_rows(spark, awkward, monkeypatch):
    items = spark.createDataFrame([(3, "one two three four five six"), (1, "One, two; three four five six"), (5, "solo"), (6, ""), (7, "...")], "item_id long, text string")
    rows = lambda: sorted(map(tuple, C.contamination(awkward, items).collect()), key=repr)
    one = rows()
    monkeypatch.setattr(C, "BLOCK_BYTES", 3)
    monkeypatch.setattr(C, "FILTER_BITS", 6)  # a filter that is full rules nothing out
    assert rows() == one


def test_awkward_rows(spark, awkward):
    items = spark.createDataFrame(
        [(3, "one two three four five six"), (1, "One, two; three four five six"), (None, "solo"), (5, None), (6, ""), (7, "...")],
        "item_id long, text string").selectExpr("*", "0 AS doc_id")
    found = {(r.doc_id, r.contaminated, r.n_items, r.item_id) for r in C.contamination(awkward, items).collect()}
    assert found == {(1, True, 2, 1), (7, True, 2, 1), (None, True, 2, 1), (None, False, 0, None)} | {
        (k, False, 0, None) for k in (2, 3, 4, 5, 6, 8)}
    assert C.drop_contaminated(awkward, items).columns == awkward.columns
    assert C.contamination(awkward.limit(0), items).collect() == []
    assert not any(r.contaminated for r in C.contamination(awkward, items.limit(0)).collect())


def test_rows_do_not_depend_on_the_number_of_blocks(spark, monkeypatch):
    docs, items, _ = fixture(spark)
    docs = docs.selectExpr("CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 3 = 1 THEN doc_id % 5 ELSE doc_id END AS doc_id", "text")
    docs = docs.union(docs.limit(7))
    rows = lambda: sorted((tuple(r) for r in C.contamination(docs, items).collect()), key=repr)
    one = rows()
    monkeypatch.setattr(C, "BLOCK_BYTES", 500)
    assert rows() == one and len(one) == docs.count()
