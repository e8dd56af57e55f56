"""Periodic runs against the definition: every period, every maximal stretch."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from vulnatlas.llm import periodic_runs
from vulnatlas.llm.periodic_runs import text_runs


def plain_runs(words):
    """All stretches of equal words a period apart, the smallest period of each kept."""
    found = {}
    for period in range(1, len(words) // 4 + 1):
        start = 0
        while start + period < len(words):
            end = start
            while end + period < len(words) and words[end] == words[end + period]:
                end += 1
            if end > start and end - start + period >= max(6, 4 * period):
                found.setdefault((start, end + period), period)
            start = max(end, start) + 1
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda run: (run[0], run[2]))


def looping(rng):
    """Words of few kinds with loops of all sizes put in, next to and inside each other."""
    words = []
    for _ in range(rng.randint(0, 6)):
        unit = [bytes([97 + rng.randint(0, rng.choice([0, 1, 3, 20]))]) for _ in range(rng.randint(1, 20))]
        unit = unit * rng.choice([1, 1, 3]) + unit[:1] * rng.randint(0, 5)
        words += (unit * rng.randint(1, 9))[rng.randint(0, 3):]
    return words


@pytest.mark.parametrize("piece", [1, 7, 64, 1 << 18])
def test_runs_equal_the_definition_however_words_are_appended(piece):
    rng = random.Random(piece)
    texts = [looping(rng) for _ in range(60 if piece == 1 else 250)]
    texts += [[], [b"a"] * 5, [b"a"] * 6, [b"a", b"b"] * 4, [b"a", b"b"] * 4 + [b"a"], [b"x"] * 300, [b"q"] + [b"x"] * 4097]
    for words, found in zip(texts, text_runs(texts, piece), strict=True):
        assert found == plain_runs(words)


def test_query_against_the_contract(spark):
    rng = random.Random(5)
    rows = [(k, " \t".join(rng.choice(["ab", "cd", "é"]) + str(rng.randint(0, 9)) for _ in range(rng.randint(0, 90)))) for k in range(120)]
    rows += [(500, None), (501, ""), (502, "\n"), (503, "wörd " * 40), (503, "wörd " * 40), (None, "a b " * 9)]
    got = periodic_runs.digest(periodic_runs.periodic_runs(periodic_runs.with_loops(spark.createDataFrame(rows, "doc_id long, text string"))))
    want = []
    for doc_id, text in rows:
        words = (text or "").encode().split()
        h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = plain_runs(words)
        dropped = {k for s, m, q in runs for k in range(s + q, s + m)}
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        longest = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        kept = b" ".join(w for k, w in enumerate(words) if k not in dropped)
        want.append((doc_id, len(runs), *longest, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()))
    assert any(row[1] for row in want[:120])
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_awkward_rows(awkward, spark):
    got = periodic_runs.periodic_runs(awkward).collect()
    assert len(got) == awkward.count()
    texts = {row.doc_id: row.text for row in got}
    assert (texts[2], texts[3], texts[4], texts[8]) == ("", "", "", "solo")
    assert periodic_runs.digest(periodic_runs.periodic_runs(spark.createDataFrame([], "doc_id long, text string"))).collect() == []
