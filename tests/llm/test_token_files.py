"""Packed ids: exact round trips, and documents as read back from files against the tokenizer itself."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from vulnatlas.llm import token_files as T

ids = st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 60_000) | st.integers(0, 1), max_size=300)


@settings(max_examples=200, deadline=None)
@given(ids, st.integers(1, 40))
def test_packing_round_trip(values, times):
    values = np.array(values * times, np.uint64)
    words, offsets = T.pack(values)
    assert np.array_equal(T.unpack(words, offsets, len(values)), values) and len(offsets) == -(-len(values) // T.BLOCK)


def test_packing_is_tight():
    assert len(T.pack(np.zeros(1024, np.uint64))[0]) == 18  # 17 words of 60 and one of 4
    assert len(T.pack(np.full(1020, 2**15 - 1, np.uint64))[0]) == 255
    assert len(T.pack(np.full(3, 2**60, np.uint64))[0]) == 6


def test_files_keep_documents_and_refuse_others():
    values = np.arange(5000, dtype=np.uint64)
    data = T.file_bytes(np.array([3, 9]), np.array([1000, 4000], np.uint64), values)
    docs, counts, back = T.read_file(data)
    assert docs.tolist() == [3, 9] and counts.tolist() == [1000, 4000] and np.array_equal(back, values)
    with pytest.raises(ValueError):
        T.read_file(b"abcd" + data[4:])


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(max_size=40) | st.text("aB ¤é\n<|>'s1", max_size=30), max_size=6))
def test_words_give_the_ids_of_whole_texts(texts):
    words = T.WordTokens(T.default_tokenizer())
    texts = [t.encode("utf-8", "replace").decode() for t in texts]
    whole = [e.ids for e in words.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(i, "<u4").tolist() for i in words.encode([t.encode() for t in texts])] == whole


@pytest.mark.parametrize("per_file", [8_000_000, 50])
def test_awkward_rows(spark, awkward, monkeypatch, per_file):
    monkeypatch.setattr(T, "FILE_IDS", per_file)
    tokenizer = Tokenizer.from_file(T.default_tokenizer())
    rows = sorted(((-1 if r.doc_id is None else r.doc_id, r.text or "") for r in awkward.collect()))
    want, start = [], 0
    for doc_id, text in rows:
        own = tokenizer.encode(text, add_special_tokens=False).ids + [T.END_ID]
        want.append((doc_id, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
        start += len(own)
    found = [(-1 if r.doc_id is None else r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in T.round_trip(awkward).collect()]
    assert sorted(found) == sorted(want)
    assert T.round_trip(awkward.limit(0)).collect() == []


class Counting:
    """The merges, and every part that went to them."""

    def __init__(self, merges):
        self.merges, self.seen = merges, []

    def encode_batch_fast(self, texts, **options):
        self.seen += [part for text in texts for part in text.split()]
        return self.merges.encode_batch_fast(texts, **options)


def test_words_met_most_are_not_forgotten(monkeypatch):
    """However many words come, one of every text goes to the merges once; and the ids stay right."""
    monkeypatch.setattr(T, "KEPT_WORDS", 20)
    words = T.WordTokens(T.default_tokenizer())
    words.merges = counting = Counting(words.merges)
    for k in range(60):
        text = f"often often caf\xe9 {' '.join('abcdefghij'[int(d)] * 3 + chr(97 + k % 26) * j for j, d in enumerate(str(k + 100)))}"
        found = np.frombuffer(words.encode([text.encode()])[0], "<u4").tolist()
        assert found == words.tokenizer.encode(text, add_special_tokens=False).ids
    assert counting.seen.count("often") == 1 and len(set(counting.seen)) > 60


def test_long_words_are_not_kept_for_ever(monkeypatch):
    monkeypatch.setattr(T, "KEPT_BYTES", 20_000)
    words = T.WordTokens(T.default_tokenizer())
    for k in range(40):
        for text in (f"often {chr(97 + k % 26) * (900 + k)}", f"\u2019 often {chr(97 + k % 26) * (900 + k)}"):
            found = np.frombuffer(words.encode([text.encode()])[0], "<u4").tolist()
            assert found == words.tokenizer.encode(text, add_special_tokens=False).ids
            assert max(known.words.nbytes + known.ids.nbytes for known in (words.known_parts, words.known_words)) < 25_000
            assert b"often" in words.known_parts.words.to_pylist() and sum(map(len, words.parts)) < 25_000


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(max_codepoint=255) | st.sampled_from("''''stmdrevl 1aB"), max_size=60))
def test_latin_texts_are_cut_like_the_pattern(text):
    lowered = (text.encode("latin-1") + b"  ").translate(T.LOWERED)
    solid, begun = T.cut_parts(lowered)
    last = 0
    cut = []
    for first in np.flatnonzero(begun).tolist():
        last = first + 1
        while solid[last] and not begun[last]:
            last += 1
        cut.append(lowered[first:last].decode("latin-1"))
    assert cut == T.CUT.findall(text.lower()) and sum(map(len, cut)) == int(solid.sum())


def test_a_worker_loads_the_tokenizer_once(spark, tmp_path, monkeypatch):
    class Noted(T.WordTokens):
        def __init__(self, path):
            import os

            super().__init__(path)
            with open(tmp_path / "loads", "a") as out:
                out.write(f"{os.getpid()}\n")

    monkeypatch.setattr(T, "WordTokens", Noted)
    tasks = 4 * spark.sparkContext.defaultParallelism
    before = {key: spark.conf.get(key) for key in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", tasks)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        files = T.write_tokens(spark.range(20 * tasks).selectExpr("id AS doc_id", "'some words' AS text"), str(tmp_path / "ids")).collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    loads = (tmp_path / "loads").read_text().split()
    assert len(files) > spark.sparkContext.defaultParallelism and len(loads) == len(set(loads))
