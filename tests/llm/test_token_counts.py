"""The automaton against plain greedy longest match."""

from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st

from vulnatlas.llm.token_counts import Automaton, default_model, pieces_of, token_counts


def greedy(word, starts, inside):
    """Longest match from the left, 1 if it gets stuck."""
    at = total = 0
    while at < len(word):
        names = inside if at else starts
        end = next((e for e in range(len(word), at, -1) if word[at:e] in names), None)
        if end is None:
            return 1
        at, total = end, total + 1
    return total


names = st.sets(st.text("abc", min_size=1, max_size=4), max_size=12)


@settings(max_examples=400, deadline=None)
@given(names, names, st.text("abcd", max_size=12))
def test_counts_are_those_of_longest_match(starts, inside, word):
    assert Automaton(sorted(starts), sorted(inside)).count(word) == greedy(word, starts, inside)


def test_whole_texts(spark):
    starts, inside = map(set, pieces_of(default_model()))
    long = "mississippi " * 20_000
    rows = [(1, "Hello world, naïve\tzzzqqq 日本\n"), (2, None), (3, ""), (3, " \n"), (None, "a"), (4, long)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n_tokens", "2 AS n_words")
    got = {(r.doc_id, r.n_words, r.n_tokens) for r in token_counts(docs).collect()}
    want = {(i, len((t or "").split()), sum(greedy(w, starts, inside) for w in (t or "").split())) for i, t in rows}
    assert got == want
    assert token_counts(docs.limit(0)).collect() == []
