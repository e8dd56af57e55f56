"""Prefix trie of conversations by the Euler-tour technique.

Conversations that begin with the same turns share a node for each of them. A node belongs to its smallest member,
so the nodes of one conversation, from where it leaves a smaller one to its last turn, form a path. The Euler tour
enters and leaves every node. Children are visited by their smallest member, so a path is entered from top to end
without a stop, and left again in stretches between the nodes where other paths branch off: arcs that follow each
other with no branch between are one element of a linked list. The list is ranked distributedly, the entered
nodes' leaves and savings are summed along the ranks, and a subtree's sums are the difference of the prefix sums
where its node is left and entered.

A prefix is known by the exclusive or of two 64-bit hashes of its turns and their places, so it needs no sorted
text and no chain: texts are hashed (SHA-256, 128 bits of it) and counted once, and only these travel.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vulnatlas.llm.scans import SPAN, list_ranks, running
from vulnatlas.llm.text import remove_stored, stored

WORD = r"[^\x20\x09-\x0D]+"
#: Ids in a piece of a list of members.
PIECE = 65536
NO_MEMBERS = hashlib.sha256(b"").hexdigest()


def numbered(turns: DataFrame) -> DataFrame:
    """``conv_id, i, said, words``: each turn's place in its conversation from 0, a hash of role and text, and its words.

    By turn, null first; turns of the same number by their hash. A null role or text is empty; rows without a
    conv_id are left out.
    """
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("role", "text"))
    said = F.unhex(F.substring(F.sha2(F.concat_ws(":", F.length(role), F.concat(role, text)).cast("binary"), 256), 1, 32))
    slim = turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), said.alias("said"),
        F.regexp_count(text, F.lit(WORD)).alias("words"),
    )
    segment = F.coalesce(F.expr(f"turn div {SPAN}"), F.lit(-(1 << 62)))
    counted = running(slim, ["conv_id"], segment, [F.asc_nulls_first("turn"), "said"], {"i": F.lit(1).cast("long")})
    return counted.select("conv_id", (F.col("i") - 1).alias("i"), "said", "words")


def own(turns: DataFrame) -> DataFrame:
    """``conv_id, d, said, words``, turns numbered from 1, of the conversations as they are, and all conv_ids."""
    return numbered(turns).select("conv_id", (F.col("i") + 1).alias("d"), "said", "words")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with turns of another one: ``conv_id, d, said, words``, and the conv_ids.

    With ``h = crc32(conv_id) % 4``, conversation c has the first h turns of ``c - c % 20`` and then its own after
    its first h. It may have no turn at all.
    """
    rows = stored(numbered(turns), "turns")
    h = F.crc32(F.col("conv_id").cast("string")) % 4
    base = F.col("conv_id") - F.col("conv_id") % 20
    ids = stored(rows.select("conv_id").distinct(), "conversations")
    heads = rows.filter((F.col("conv_id") % 20 == 0) & (F.col("i") < 3)).withColumnRenamed("conv_id", "base")
    known = heads.groupBy("base").agg(F.count("*").alias("n_base"))
    kept = rows.filter(F.col("i") >= h).withColumn("base", base).join(known, "base", "left")
    given = F.least(h, F.coalesce("n_base", F.lit(0)))
    kept = kept.select("conv_id", (given + F.col("i") - h + 1).alias("d"), "said", "words")
    lent = ids.select("conv_id", base.alias("base"), h.alias("h")).join(heads, "base").filter("i < h")
    out = stored(kept.union(lent.select("conv_id", (F.col("i") + 1).alias("d"), "said", "words")), "rebuilt")
    remove_stored(rows)
    return out, ids


def _member_hashes(ends: DataFrame) -> DataFrame:
    """``d, p1, p2, ends_sha256``: the hash of the members that end at a node, ascending.

    Ids are sorted and written in pieces; the pieces of a node pass through the hash one by one.
    """
    key = ["d", "p1", "p2"]
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    pieces = ends.groupBy(*key, F.expr(f"conv_id div {PIECE}").alias("piece")).agg(ids.alias("ids"))

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, digest = None, hashlib.sha256()
        for batch in batches:
            out = []
            for d, p1, p2, ids in zip(batch["d"], batch["p1"], batch["p2"], batch["ids"], strict=True):
                if (d, p1, p2) != now:
                    if now is not None:
                        out.append((*now, digest.hexdigest()))
                    now, digest = (d, p1, p2), hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield pd.DataFrame(out, columns=[*key, "ends_sha256"])
        if now is not None:
            yield pd.DataFrame([(*now, digest.hexdigest())], columns=[*key, "ends_sha256"])

    return pieces.repartition(*key).sortWithinPartitions(*key, "piece").mapInPandas(hashed, "d long, p1 long, p2 long, ends_sha256 string")


def _nodes(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``owner, d, n, words, p1, p2, q1, q2, ends_sha256`` of each node: q is the prefix of its parent."""
    turn = rows.select("conv_id", "d", "words", *(F.xxhash64(F.lit(k), "d", "said").alias(f"a{k}") for k in (1, 2)))
    along = running(turn, ["conv_id"], F.expr(f"d div {SPAN}"), ["d"], {"p1": F.col("a1"), "p2": F.col("a2")}, F.bit_xor)
    nodes = along.groupBy("d", "p1", "p2").agg(
        F.min("conv_id").alias("owner"), F.count("*").alias("n"), F.min("words").alias("words"),
        F.min("a1").alias("a1"), F.min("a2").alias("a2"),
    )
    whole = turn.groupBy("conv_id").agg(F.count("*").alias("d"), F.bit_xor("a1").alias("p1"), F.bit_xor("a2").alias("p2"))
    none = F.lit(0).cast("long")
    ends = ids.join(whole, "conv_id", "left").select("conv_id", *(F.coalesce(name, none).alias(name) for name in ("d", "p1", "p2")))
    nodes = nodes.select(
        "owner", "d", "n", "words", "p1", "p2",
        F.col("p1").bitwiseXOR(F.col("a1")).alias("q1"), F.col("p2").bitwiseXOR(F.col("a2")).alias("q2"))
    root = ids.agg(F.min("conv_id").alias("owner"), F.count("*").alias("n")).filter("n > 0").select(
        "owner", none.alias("d"), "n", F.lit(0).alias("words"), *(none.alias(name) for name in ("p1", "p2", "q1", "q2")))
    return nodes.unionByName(root).join(_member_hashes(ends), ["d", "p1", "p2"], "left")


def _next_sibling(branches: DataFrame) -> DataFrame:
    """``branches`` (c, p, pd) with ``sib``, the next larger c below the same node, null for the last.

    Children of a node are looked at in ranges of ids, then the ranges' first ones.
    """
    cut = branches.withColumn("range", F.expr(f"c div {SPAN}"))
    near = cut.withColumn("near", F.lead("c").over(Window.partitionBy("p", "pd", "range").orderBy("c")))
    firsts = cut.groupBy("p", "pd", "range").agg(F.min("c").alias("first"))
    far = firsts.withColumn("far", F.lead("first").over(Window.partitionBy("p", "pd").orderBy("range"))).drop("first")
    return near.join(far.filter("far IS NOT NULL"), ["p", "pd", "range"], "left").select("c", "p", "pd", F.coalesce("near", "far").alias("sib"))


def prefix_trie(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """A row for each node of the trie of conversations.

    ``rows`` has ``conv_id, d, said, words`` with d from 1 upwards in each conversation, as :func:`own` and
    :func:`rebuilt` give it; ``ids`` all conv_ids, those without turns too. Result: ``conv_id`` (smallest member),
    ``depth``, ``parent_conv_id`` (null for the root), ``n_convs`` (members), ``n_children``, ``n_leaves`` and
    ``saved_tokens`` of the subtree, ``ends_sha256`` of the members that end here. No conversations, no rows.
    """
    nodes = stored(_nodes(rows, ids), "nodes")
    top = nodes.filter("d = 0").select("owner").first()
    paths = nodes.groupBy("owner").agg(
        F.min("d").alias("d0"), F.max("d").alias("last"), F.min_by(F.struct("q1", "q2"), "d").alias("q"))
    heads = paths.filter("d0 > 0").select(F.col("owner").alias("c"), F.col("d0"), F.col("q.*"))
    below_root = heads.filter("d0 = 1").select("c", F.lit(top and top.owner).cast("long").alias("p"), F.lit(0).cast("long").alias("pd"))
    parents = nodes.select(F.col("owner").alias("p"), F.col("d").alias("pd"), F.col("p1").alias("q1"), F.col("p2").alias("q2"))
    deeper = heads.filter("d0 > 1").withColumn("pd", F.col("d0") - 1).join(parents.filter("pd > 0"), ["pd", "q1", "q2"]).select("c", "p", "pd")
    branches = stored(_next_sibling(below_root.unionByName(deeper)), "branches")

    # What is special about a node: paths that branch off, the end of its path, the path above its first node.
    marks = branches.groupBy(F.col("p").alias("owner"), F.col("pd").alias("d")).agg(
        F.count("*").alias("n_branch"), F.min("c").alias("first"), F.max("c").alias("final"))
    marks = marks.unionByName(paths.select("owner", F.col("last").alias("d"), F.lit(True).alias("tail")), allowMissingColumns=True)
    marks = marks.unionByName(branches.select(F.col("c").alias("owner"), (F.col("pd") + 1).alias("d"), F.col("p").alias("parent")), allowMissingColumns=True)
    marks = marks.groupBy("owner", "d").agg(
        F.sum("n_branch").alias("n_branch"), F.min("first").alias("first"), F.max("final").alias("final"),
        F.max("tail").alias("tail"), F.max("parent").alias("parent"))
    n_branch = F.coalesce("n_branch", F.lit(0).cast("long"))
    n_children = n_branch + F.when(F.col("tail"), 0).otherwise(1)
    marked = stored(nodes.select("owner", "d", "n", "words", "ends_sha256").join(marks, ["owner", "d"], "left").select(
        "owner", "d", "n", "ends_sha256", "first", "final", F.coalesce("parent", F.when(F.col("d") > 0, F.col("owner"))).alias("parent"),
        n_children.alias("n_children"), (n_branch > 0).cast("long").alias("branch"), (n_children == 0).cast("long").alias("leaf"),
        ((F.col("n") - 1) * F.col("words")).alias("saved")), "marked")
    remove_stored(nodes)

    # From the end of a path upwards: its own leaves and savings, and how many nodes with branches there are.
    sums = {"n_leaves": F.col("leaf"), "saved_tokens": F.col("saved"), "k": F.col("branch")}
    upwards = running(marked, ["owner"], -F.expr(f"d div {SPAN}"), [F.desc("d")], sums)
    after = _tour(marked, upwards, branches)
    alone = upwards.filter("k = 0")
    above = upwards.filter("k > 0").join(after.withColumnRenamed("c", "owner"), ["owner", "k"])
    above = above.withColumns({name: F.col(name) + F.col(f"more_{name}") for name in ("n_leaves", "saved_tokens")})
    return alone.unionByName(above.drop("more_n_leaves", "more_saved_tokens")).select(
        F.col("owner").alias("conv_id"), F.col("d").alias("depth"), F.when(F.col("d") > 0, F.col("parent")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"), "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(NO_MEMBERS)).alias("ends_sha256"))


def _tour(marked: DataFrame, upwards: DataFrame, branches: DataFrame) -> DataFrame:
    """``c, k, more_n_leaves, more_saved_tokens``: what the tour enters between the end of path c and its k-th way up.

    Element (c, 0) enters path c and leaves its nodes below the lowest branch; (c, k) leaves those from the k-th
    branch from below up to the next one.
    """
    totals = marked.groupBy("owner").agg(
        F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens"), F.sum("branch").alias("k")).withColumnRenamed("owner", "c")
    totals = stored(totals, "paths")
    forks = stored(upwards.filter("branch = 1").select("owner", "k", "first", "final"), "forks")
    zero = F.lit(0).cast("long")
    # Left for the last time: on to the next path below the same node, or up where there is none.
    onwards = branches.filter("sib IS NOT NULL").select("c", F.col("sib").alias("nc"), zero.alias("nt"))
    onwards = onwards.union(forks.select(F.col("final").alias("c"), F.col("owner").alias("nc"), F.col("k").alias("nt")))
    links = totals.select("c", F.col("k").alias("t")).join(onwards, "c", "left")
    links = links.unionByName(forks.select(F.col("owner").alias("c"), (F.col("k") - 1).alias("t"), F.col("first").alias("nc"), zero.alias("nt")))
    ranks = list_ranks(links.withColumn("w", F.when(F.col("nc").isNull(), 0).otherwise(1).cast("long")))
    values = totals.select("c", zero.alias("t"), "n_leaves", "saved_tokens")
    places = stored(ranks.join(values, ["c", "t"], "left").fillna(0, ["n_leaves", "saved_tokens"]), "tour")
    sums = {f"more_{name}": F.col(name) for name in ("n_leaves", "saved_tokens")}
    summed = running(places, [], -F.expr(f"rank div {SPAN}"), [F.desc("rank")], sums, levels=2)
    summed = stored(summed.select("c", "t", *sums), "sums")
    remove_stored(places, ranks, totals, forks)
    entered = summed.filter("t = 0").select("c", *(F.col(name).alias(f"at_{name}") for name in sums))
    return summed.filter("t > 0").join(entered, "c").select(
        "c", F.col("t").alias("k"), *((F.col(name) - F.col(f"at_{name}")).alias(name) for name in sums))
