"""A search index that grows by segments: appended to, searched while it grows, merged now and then.

Every append writes a segment of its own: its rows, their postings, the vocabulary with how often each token occurs,
character grams for substring search, a filter of its keys, and its share of the summaries. One published state (:mod:`vulnatlas.sinks.manifest`)
names the live segments; a segment without a state that names it does not exist for readers, so an append that was
stopped leaves nothing behind and may simply be run again. A merge folds small segments into one without tokenising
again.

Rows and postings lie in blocks of one score step (10 down to 0, and unscored), each sorted by token and id. All
postings of a row share its block, so a block can be searched by itself, and a search for the best rows reads blocks
from the top until it has enough. The vocabulary tells the rarest token that a match must hold; where few rows
hold it, they narrow the scan of the frequent ones.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vulnatlas.operators.filters import advisory_filters, contains
from vulnatlas.operators.key_filters import key_filter, may_be_stored, words_for
from vulnatlas.operators.limits import top_scored
from vulnatlas.operators.match_tree import Tree, analyzed, match_tree, required
from vulnatlas.operators.merging import one_per_key
from vulnatlas.operators.ngrams import gram_postings, substring_rows
from vulnatlas.operators.postings import build_postings
from vulnatlas.operators.summaries import merged_summary, partial_summary
from vulnatlas.session import hadoop_path, staged
from vulnatlas.sinks.manifest import publish_state, read_state, remove_older_states, remove_unused

UNSCORED = -1
#: Rows that hold the rarest token up to which their ids are broadcast to narrow the postings of the other tokens.
NARROW_IDS = 100_000
#: Keys that may be stored up to which they are given to the scan of the stored ones.
KEYS_IN_SCAN = 1000
#: Rows whose postings of one block a task of a merge sorts at least, if the block has so many.
ROWS_PER_FILE = 10_000
PARTS = ("rows", "postings", "terms", "grams", "gram_terms", "keys", "summary")


def folder(root: str, part: str, segment: str) -> str:
    return f"{root}/{part}/segment={segment}"


@dataclass(frozen=True)
class Index:
    """The live segments as of one published state."""

    spark: SparkSession
    root: str
    number: int
    state: dict

    def part(self, name: str, segments: list[dict] | None = None) -> DataFrame | None:
        """One part of the given segments, or of all; None where there is none."""
        chosen = [folder(self.root, name, s["name"]) for s in (self.segments if segments is None else segments)]
        return self.spark.read.option("basePath", f"{self.root}/{name}").parquet(*chosen).drop("segment") if chosen else None

    @property
    def segments(self) -> list[dict]:
        return self.state.get("segments", [])

    @property
    def rows(self) -> DataFrame:
        return self.part("rows")

    @property
    def postings(self) -> DataFrame:
        return self.part("postings")

    def terms(self) -> DataFrame:
        """``token, n``: in how many fields of rows each token occurs."""
        return self.part("terms").groupBy("token").agg(F.sum("n").alias("n"))

    def blocks(self) -> dict[int, int]:
        """Rows of each block, the best score first."""
        sizes: dict[int, int] = {}
        for segment in self.segments:
            for block, n in segment["blocks"].items():
                sizes[int(block)] = sizes.get(int(block), 0) + n
        return dict(sorted(sizes.items(), reverse=True))


def open_index(spark: SparkSession, root: str) -> Index:
    number, state = read_state(spark, root)
    return Index(spark, root.rstrip("/"), number, state)


def _block(score: str) -> Column:
    """Score steps of one; what is not scored comes last, a score that is no number too."""
    return F.when(F.col(score).isNull() | F.isnan(score), UNSCORED).otherwise(F.floor(F.least(F.greatest(score, F.lit(0.0)), F.lit(10.0)))).cast("int")


def unseen(index: Index, incoming: DataFrame, key: str) -> DataFrame:
    """Rows of ``incoming`` whose key no live segment holds, null keys included.

    The segments' filters rule out most of them; stored keys are read only in segments that may hold one, and
    only around these keys where they are few.
    """
    for segment in index.segments:
        stored_filter = index.part("keys", [segment])
        suspects = may_be_stored(incoming.filter(F.col(key).isNotNull()), key, stored_filter, segment["filter_words"])
        few = suspects.limit(KEYS_IN_SCAN + 1).collect()
        if not few:
            continue
        stored = index.part("rows", [segment]).select(key)
        stored = stored.filter(F.col(key).isin([r[0] for r in few])) if len(few) <= KEYS_IN_SCAN else stored.join(suspects, key, "left_semi")
        incoming = incoming.join(stored, key, "left_anti")
    return incoming


def append_segment(
    spark: SparkSession, df: DataFrame, root: str, *order: str | Column, key: str = "id", fields: tuple[str, ...] = ("id", "description"),
    score: str = "cvss", substring: str | None = "description", stem: bool = True, transient: tuple[str, ...] = (), batch: tuple[str, int] | None = None,
) -> int:
    """Store the rows whose key is not stored yet, searchable at once; how many there were.

    Of a key the first row in ``order`` counts, or else in that of all columns. The column ``substring`` gets character
    grams; None for none. ``batch`` is the name of a stream and a number: a batch that a state has already is passed
    over. How the index was first made holds for all of it.
    """
    root = root.rstrip("/")
    index = open_index(spark, root)
    if batch and index.state.get("batches", {}).get(batch[0], -1) >= batch[1]:
        return 0
    made = {"key": key, "fields": list(fields), "score": score, "substring": substring, "stem": stem}
    if index.state and index.state["made"] != made:
        raise ValueError(f"{root} was made with {index.state['made']}, not {made}")
    fresh = unseen(index, one_per_key(df, key, *order), key).drop(*transient).withColumn("block", _block(score))
    name = f"s{uuid.uuid4().hex}"
    (
        fresh.hint("rebalance", "block").sortWithinPartitions("block", key).write.partitionBy("block")
        .option(f"parquet.bloom.filter.enabled#{key}", "true").parquet(folder(root, "rows", name))
    )
    segments = list(index.segments)
    rows = spark.read.schema(fresh.schema).parquet(folder(root, "rows", name))
    blocks = {str(r.block): r["count"] for r in rows.groupBy("block").count().collect()}
    n = sum(blocks.values())
    if n:
        words = words_for(n)
        _write_postings(rows, key, fields, stem, root, name)
        if substring:
            with staged(gram_postings(rows, key, substring), "grams") as found:
                _write_grams(found, root, name)
        _write_keys(rows, key, words, root, name)
        partial_summary(rows, score).write.parquet(folder(root, "summary", name))
        segments.append({"name": name, "rows": n, "blocks": blocks, "filter_words": words})
    else:
        target, fs = hadoop_path(spark, folder(root, "rows", name))
        fs.delete(target, True)
    batches = index.state.get("batches", {}) | ({batch[0]: batch[1]} if batch else {})
    if n or batch:
        publish_state(spark, root, index.number, {"made": made, "segments": segments, "batches": batches})
    return n


def _write_postings(rows: DataFrame, key: str, fields: tuple[str, ...], stem: bool, root: str, name: str) -> None:
    """Postings by block, token and id, and the vocabulary.

    Texts are dealt out in ranges of block and key before they are tokenised: a row's postings are many times its
    size and stay in its task, which sorts them once; texts that come in order give long sorted runs. So a task has
    few blocks, and the work follows the rows, not the files that they lie in.
    """
    texts = rows.select(*dict.fromkeys((key, *fields, "block"))).repartitionByRange("block", key).sortWithinPartitions("block", key)
    _sorted_postings(build_postings(texts, key, fields, stem, keep=("block",)), root, name)
    postings = rows.sparkSession.read.parquet(folder(root, "postings", name))
    _write_terms(postings.groupBy("token").agg(F.count("*").alias("n")), root, name)


def _sorted_postings(postings: DataFrame, root: str, name: str) -> None:
    """The postings of each task, sorted in files of its own."""
    (
        postings.sortWithinPartitions("block", "token", "id").write.partitionBy("block")
        .option("parquet.bloom.filter.enabled#token", "true").parquet(folder(root, "postings", name))
    )


def _write_terms(terms: DataFrame, root: str, name: str) -> None:
    terms.repartitionByRange("token").sortWithinPartitions("token").write.parquet(folder(root, "terms", name))


def _write_grams(grams: DataFrame, root: str, name: str) -> None:
    grams.repartitionByRange("gram", "id").sortWithinPartitions("gram", "id").select("gram", "id").write.parquet(folder(root, "grams", name))
    counted = grams.groupBy("gram").agg(F.count("*").alias("n"))
    counted.repartitionByRange("gram").sortWithinPartitions("gram").write.parquet(folder(root, "gram_terms", name))


def _write_keys(rows: DataFrame, key: str, words: int, root: str, name: str) -> None:
    key_filter(rows, key, words).hint("rebalance").sortWithinPartitions("word").write.parquet(folder(root, "keys", name))


def merge_segments(spark: SparkSession, root: str, smaller_than: int | None = None) -> int:
    """Fold the segments of fewer rows, or all, into one; how many there were. Readers of older states are not disturbed."""
    index = open_index(spark, root)
    chosen = [s for s in index.segments if smaller_than is None or s["rows"] < smaller_than]
    if len(chosen) < 2:
        return 0
    key, name = index.state["made"]["key"], f"s{uuid.uuid4().hex}"
    rows = index.part("rows", chosen)
    (
        rows.hint("rebalance", "block").sortWithinPartitions("block", key).write.partitionBy("block")
        .option(f"parquet.bloom.filter.enabled#{key}", "true").parquet(folder(index.root, "rows", name))
    )
    _fold_postings(index, chosen, name)
    _write_terms(index.part("terms", chosen).groupBy("token").agg(F.sum("n").alias("n")), index.root, name)
    if index.state["made"]["substring"]:
        _write_grams(index.part("grams", chosen), index.root, name)
    n = sum(s["rows"] for s in chosen)
    words = words_for(n)
    _write_keys(rows, key, words, index.root, name)
    merged_summary(index.part("summary", chosen)).write.parquet(folder(index.root, "summary", name))
    blocks: dict[str, int] = {}
    for segment in chosen:
        for block, size in segment["blocks"].items():
            blocks[block] = blocks.get(block, 0) + size
    kept = [s for s in index.segments if s not in chosen]
    merged = {"name": name, "rows": n, "blocks": blocks, "filter_words": words}
    publish_state(spark, index.root, index.number, index.state | {"segments": [*kept, merged]})
    return len(chosen)


def _fold_postings(index: Index, chosen: list[dict], name: str) -> None:
    """The postings of the given segments, block by block, sorted anew without a shuffle.

    A block's files are read by as many tasks as its rows ask for, each of which writes one file: small ones are
    folded together, and large ones, sorted already, are merged with few others.
    """
    sizes = Index(index.spark, index.root, index.number, {"segments": chosen}).blocks()
    blocks = [
        index.part("postings", chosen).filter(F.col("block") == block).coalesce(-(-n // ROWS_PER_FILE)) for block, n in sizes.items() if n]
    _sorted_postings(reduce(DataFrame.unionAll, blocks), index.root, name)


def vacuum(spark: SparkSession, root: str) -> list[str]:
    """Remove segments that are not live any more, or never were, while nobody reads or writes; their names."""
    index = open_index(spark, root)
    live = {f"segment={s['name']}" for s in index.segments}
    gone = [name for part in PARTS for name in remove_unused(spark, f"{index.root}/{part}", live)]
    remove_older_states(spark, index.root)
    return sorted(set(gone))


def _frequencies(index: Index, tokens: set[str]) -> dict[str, int]:
    found = index.terms().filter(F.col("token").isin(sorted(tokens))).collect()
    return dict.fromkeys(tokens, 0) | {r.token: r.n for r in found}


def matching_ids(index: Index, tree: Tree, blocks: list[int] | None = None) -> DataFrame:
    """Distinct ids of the rows that match, of some blocks or all.

    The vocabulary is asked first: where a word that every match needs is nowhere, no posting is read; where the
    rarest is in few rows, only their postings are looked at.
    """
    stem = index.state["made"]["stem"]
    needed = required(tree, analyzed(index.spark, tree, stem))
    held = _frequencies(index, needed) if needed else {}
    postings = index.postings if blocks is None else index.postings.filter(F.col("block").isin(blocks))
    narrowed = None
    if held:
        n, rarest = min((n, token) for token, n in held.items())
        if not n:
            postings = postings.filter(F.lit(False))
        elif n <= NARROW_IDS and len(held) > 1:
            narrowed = F.broadcast(postings.filter(F.col("token") == rarest).select("id").distinct())
    return match_tree(postings, tree, stem, narrowed)


def blocks_for(index: Index, found, limit: int, blocks: dict[int, int], share: float) -> list[int]:
    """The best blocks that surely hold ``limit`` of the rows ``found(blocks)``, or all of them.

    As many blocks as should hold twice the limit if ``share`` of the rows match are tried first, then twice as many.
    """
    order, expected, n = list(blocks), 0.0, 0
    while n < len(order) and (n == 0 or expected < 2 * limit):
        expected += blocks[order[n]] * share
        n += 1
    while n < len(order) and found(order[:n]).limit(limit).count() < limit:
        n = min(len(order), 2 * n)
    return order[:n]


def search_index(index: Index, tree: Tree, limit: int | None = 20, **filters) -> DataFrame:
    """Live rows that match the tree and the advisory filters, best score first; ``limit=None`` for all.

    With a limit, blocks are read from the best score downwards until they hold that many rows; all below are
    left unread. Ids and scores are ranked, and the other columns are read for the chosen ids alone.
    """
    if not index.segments:
        raise ValueError(f"nothing is stored at {index.root}")
    made = index.state["made"]
    key, score = made["key"], made["score"]

    def found(blocks: list[int] | None) -> DataFrame:
        rows = index.rows if blocks is None else index.rows.filter(F.col("block").isin(blocks))
        hits = matching_ids(index, tree, blocks).withColumnRenamed("id", key)
        return advisory_filters(rows, **filters).join(hits, key)

    blocks = index.blocks()
    if filters.get("min_cvss"):
        blocks = {block: n for block, n in blocks.items() if block >= min(10, int(filters["min_cvss"]))}
    if limit is None or not blocks:
        return found(list(blocks) if filters.get("min_cvss") else None).drop("block")
    needed = required(tree, analyzed(index.spark, tree, made["stem"]))
    held = _frequencies(index, needed) if needed else {}
    share = min(1.0, min(held.values()) / max(1, sum(blocks.values()))) if held else 1.0
    read = blocks_for(index, lambda some: found(some).select(key), limit, blocks, share)
    best = top_scored(found(read).select(key, score), limit, score, key)
    rows = index.rows.filter(F.col("block").isin(read))
    return top_scored(rows.join(best.select(key), key, "left_semi"), limit, score, key).drop("block")


def substring_search(index: Index, text: str, limit: int | None = 20, column: str | None = None, **filters) -> DataFrame:
    """Live rows whose ``column``, by default the one with grams, contains ``text`` in any case, best score first.

    A column without grams is read whole.
    """
    made = index.state["made"]
    column, rows = column or made["substring"], advisory_filters(index.rows, **filters)
    if column == made["substring"]:
        found = substring_rows(rows, index.part("grams"), index.part("gram_terms"), column, text, made["key"])
    else:
        found = rows.filter(contains(column, text))
    return top_scored(found.drop("block"), limit, made["score"], made["key"])
