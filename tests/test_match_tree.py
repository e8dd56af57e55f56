"""Trees of conditions against SQLite's full-text index over the same rows."""

from __future__ import annotations

import random
import sqlite3

import pytest
from pyspark.sql import functions as F

from vulnatlas.operators.match_tree import AllOf, AnyOf, But, Near, Words, all_of, any_of, match_tree, near, prefix
from vulnatlas.operators.postings import build_postings

TEXTS = {
    1: ("apache", "Apache Log4j2 JNDI features do not protect against attacker controlled LDAP"),
    2: ("log4j apache", "The fix for Apache Log4j 2.15.0 was incomplete; log4j_core is vulnerable"),
    3: ("bash", "GNU Bash processes trailing strings after function definitions (Shellshock)"),
    4: ("http", "In Apache HTTP Server 2.4, code executing in child processes executes arbitrary code"),
    5: ("", "A command injection vulnerability; vulnerabilities in the httpd apache module"),
    6: ("b", "a b a b a c c c a"), 7: ("", ""), 8: (None, None), 9: ("x", "Éclair naïve café code café"),
}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    made = {k: (" ".join(rng.choice("abcd") for _ in range(rng.randint(0, 3))), " ".join(rng.choice("abcde") for _ in range(rng.randint(0, 30)))) for k in range(20, 90)}
    return TEXTS | made


@pytest.fixture(scope="module")
def index(spark, rows):
    table = spark.createDataFrame([(k, t, d) for k, (t, d) in rows.items()], "id long, title string, description string")
    return build_postings(table, fields=("title", "description"), stem=True).cache()


@pytest.fixture(scope="module")
def fts(rows):
    con = sqlite3.connect(":memory:")
    con.execute("CREATE VIRTUAL TABLE f USING fts5(title, description, tokenize='porter unicode61')")
    con.executemany("INSERT INTO f(rowid, title, description) VALUES (?, ?, ?)", [(k, t or "", d or "") for k, (t, d) in rows.items()])
    return lambda q: sorted(r[0] for r in con.execute("SELECT rowid FROM f WHERE f MATCH ?", (q,)))


def quoted(text):
    return f'"{text}"'


def as_fts(tree):
    if isinstance(tree, Words):
        core = ("^" if tree.first else "") + quoted(tree.text) + (" *" if tree.prefix else "")
        return f"{tree.field} : {core}" if tree.field else core
    if isinstance(tree, Near):
        core = f"NEAR({' '.join(map(quoted, tree.phrases))}, {tree.distance})"
        return f"{tree.field} : {core}" if tree.field else core
    if isinstance(tree, But):
        return f"(({as_fts(tree.wanted)}) NOT ({as_fts(tree.unwanted)}))"
    joint = " AND " if isinstance(tree, AllOf) else " OR "
    return f"({joint.join(as_fts(p) for p in tree.parts)})"


TREES = [
    Words("apache"), all_of("apache", "log4j"), any_of("Apache", "bash"), But(Words("apache"), Words("log4j")), prefix("execut"),
    prefix("executing"), prefix("Log4"), Words("apache", "title"), Words("apache", first=True), Words("apache", "title", first=True),
    Words("child process"), prefix("child proc"), prefix("arbitrary c", "description"), Near(("apache", "child"), 3), Near(("apache http", "code", "child"), 4),
    Near(("child process", "executes"), 0), Near(("code", "code"), 5), Near(("b", "c c", "a"), 2, "description"),
    But(any_of("apache", prefix("vuln"), Near(("naive", "code"), 2)), all_of(Words("http server"), any_of("child", "bash"))),
    any_of(all_of("a", Words("b", "title")), But(Words("c c"), any_of("d", "e"))), all_of(But(Words("a"), Words("b")), any_of("c", "d")),
    AnyOf((Words("ÉCLAIR"), Words("a b", first=True))), AllOf((Near(("a", "b", "c"), 1), But(prefix("d"), Words("e", "title")))),
]


@pytest.mark.parametrize("tree", TREES, ids=range(len(TREES)))
def test_trees(index, fts, tree):
    found = [r.id for r in match_tree(index, tree).collect()]
    assert sorted(found) == fts(as_fts(tree))


def test_random_near(index, fts):
    rng = random.Random(4)
    for _ in range(12):
        phrases = tuple(" ".join(rng.choice("abcde") for _ in range(rng.choice([1, 1, 2, 3]))) for _ in range(rng.randint(2, 4)))
        tree = Near(phrases, rng.randint(0, 6), rng.choice([None, "description"]))
        assert sorted(r.id for r in match_tree(index, tree).collect()) == fts(as_fts(tree)), tree


def test_one_shuffle_for_any_tree(index, plan):
    for tree in TREES[-3:]:
        initial = plan(match_tree(index, tree)).split("== Physical Plan ==")[1]
        assert initial.count("Exchange hashpartitioning") == 1


def test_the_sweep_does_not_grow_with_the_distance(spark):
    row = spark.range(1).select(F.array(F.lit(5)).alias("a"), F.array(F.lit(2_000_000_000)).alias("b"))
    assert row.select(near([F.col("a"), F.col("b")], [1, 1], 2_000_000_000)).first()[0]
    assert not row.select(near([F.col("a"), F.col("b")], [1, 1], 1_999_999_993)).first()[0]


def test_what_is_refused(index):
    for tree, said in ((Words("a"), "two characters"), (Words("++"), "without letters"), (AnyOf(()), "at least one"), (all_of(), "at least one"),
                       (Near(("a", "..."), 2), "without letters")):
        with pytest.raises(ValueError, match=said):
            match_tree(index, tree)
    assert match_tree(index, all_of("apache", "nowhere")).collect() == []
