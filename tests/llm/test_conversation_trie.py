"""The prefix trie against a plain one, with segments and lists short enough to be cut and ranked in parts."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from vulnatlas.llm import conversation_trie, scans

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
SCHEMA = "conv_id long, turn long, role string, text string"


def said(row):
    role, text = row[2] or "", row[3] or ""
    return (row[1] is not None, row[1] or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]), (role, text)


def conversations(rows):
    """Role and text of the turns of each conversation in order."""
    found = {}
    for row in sorted((r for r in rows if r[0] is not None), key=said):
        found.setdefault(row[0], []).append(said(row)[1])
    return found


def with_lent_turns(found):
    out = {}
    for c, turns in found.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(c / 20) * 20
        out[c] = found.get(c - base, [])[:h] + turns[h:]
    return out


def plain_trie(found):
    members = {}
    for c, turns in found.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = {}
    for node, ids in members.items():
        below = [other for other in members if other[:len(node)] == node]
        kids = [other for other in below if len(other) == len(node) + 1]
        leaves = sum(not any(o[:len(b)] == b and len(o) > len(b) for o in below) for b in below)
        saved = sum((len(members[b]) - 1) * len(b[-1][1].encode().split()) for b in below if b)
        ends = ",".join(str(c) for c in sorted(ids) if len(found[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out[min(ids), len(node)] = (parent, len(ids), len(kids), leaves, saved, hashlib.sha256(ends.encode()).hexdigest())
    return sorted((*key, *value) for key, value in out.items())


def rows_of(df):
    return sorted(tuple(row) for row in df.select(*COLUMNS).collect())


def many(rng, n):
    """Conversations of few kinds of turns: shared starts, copies, a very long one, and ids with gaps."""
    rows = []
    for c in rng.sample(range(n * 2), n):
        for turn in range(rng.randint(0, 9)):
            rows.append((c, turn, rng.choice(["user", "bot"]), rng.choice(["hi", "hi there", "no way at all"])))
    rows += [(7777, turn, "user", "hi" if turn < 25 else f"no {turn % 3}") for turn in range(60)]
    rows += [(7790 + k, turn, "user", "hi") for k in range(5) for turn in range(20 + k)]
    return rows


@pytest.fixture
def short(monkeypatch):
    monkeypatch.setattr(scans, "SPAN", 5)
    monkeypatch.setattr(conversation_trie, "SPAN", 5)
    monkeypatch.setattr(conversation_trie, "PIECE", 3)
    monkeypatch.setattr(scans, "SHORT_LIST", 6)


def test_own_and_lent_turns(spark, short):
    rows = many(random.Random(3), 60)
    table = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(conversation_trie.prefix_trie(*conversation_trie.rebuilt(table))) == plain_trie(with_lent_turns(conversations(rows)))
    rows_ = conversation_trie.own(table)
    ids = table.select("conv_id").distinct()
    assert rows_of(conversation_trie.prefix_trie(rows_, ids)) == plain_trie(conversations(rows))


def test_awkward_rows(spark):
    rows = [
        (1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, None, None), (2, 0, None, "a"), (2, 0, "user", ""), (3, None, "user", None),
        (None, 0, "user", "a"), (-5, 1, "user", "a"), (40, 0, "user", "b " * 40_000), (43, 0, "x", "y"), (5, 3, "user", "a"), (5, 1, "user", "a"),
    ]
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS d", "2 AS i", "3 AS said", "4 AS owner", "5 AS words")
    assert rows_of(conversation_trie.prefix_trie(*conversation_trie.rebuilt(table))) == plain_trie(with_lent_turns(conversations(rows)))
    assert rows_of(conversation_trie.prefix_trie(*conversation_trie.rebuilt(table.limit(0)))) == []


def test_list_ranks(spark, monkeypatch):
    monkeypatch.setattr(scans, "SHORT_LIST", 10)
    rng = random.Random(1)
    order = rng.sample(range(1000), 300)
    links = [(c, c % 3, n, n % 3 if n is not None else None, 2 if n is not None else 0) for c, n in zip(order, [*order[1:], None], strict=True)]
    ranks = scans.list_ranks(spark.createDataFrame(links, "c long, t long, nc long, nt long, w long")).collect()
    assert sorted(tuple(r) for r in ranks) == sorted((c, c % 3, 2 * (299 - k)) for k, c in enumerate(order))
