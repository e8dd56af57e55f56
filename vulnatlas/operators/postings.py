"""Token postings: which document holds which token, in which field, at which positions."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vulnatlas.functions.stemming import stems
from vulnatlas.functions.text import FOLDING, marked_words, tokens
from vulnatlas.session import staged

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this package

#: Words of texts that are grouped at a time; a longer text forms a slice of its own.
SLICE_WORDS = 500_000


def _grouped(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Column ``occurrences``, a sorted ``(token, positions)`` array, as ``runs`` of one per token.

    Runs are addressed by index; cutting them out with ``slice`` would copy the array each time.
    """
    occurrences = F.col("occurrences")
    starts = F.transform(
        occurrences, lambda o, i: F.when(~o["token"].eqNullSafe(F.get(occurrences, i - 1)["token"]), i)
    )
    df = df.withColumn("starts", F.array_compact(starts))

    def run(start: Column, n: Column) -> Column:
        end = F.coalesce(F.get("starts", n + 1), F.size(occurrences))
        positions = F.transform(F.sequence(start, end - 1), lambda i: F.get(occurrences, i)["positions"])
        return F.struct(
            F.get(occurrences, start)["token"].alias("token"), F.sort_array(F.flatten(positions)).alias("positions")
        )

    return df.select("id", *keep, "field", F.transform("starts", run).alias("runs"))


def _wanted(only: list[str], stem: bool):
    """Condition on a word that can yield one of the tokens ``only``.

    Stripping suffixes changes at most the last letter of what it keeps, so a word starts with all
    but the last letter of its stem; the words let through are stemmed and compared later.
    """
    if not stem:
        return lambda word: word.isin(only)
    prefixes = sorted({token[: max(1, len(token) - 1)] for token in only})
    return lambda word: reduce(Column.__or__, (word.startswith(prefix) for prefix in prefixes))


def _word_slices(batches: Iterator[pa.RecordBatch], n_fields: int) -> Iterator[pa.RecordBatch]:
    """The batches cut between rows so that each holds about ``SLICE_WORDS`` words in its last ``n_fields`` columns."""
    for batch in batches:
        if not batch.num_rows:
            continue
        counts = [np.asarray(pyarrow.compute.list_value_length(column), np.int64) for column in batch.columns[-n_fields:]]
        ends, first = np.cumsum(sum(counts)), 0
        while first < batch.num_rows:
            base = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, base + SLICE_WORDS, side="right")))
            yield batch.slice(first, last - first)
            first = last


def _occurrences(part: pa.RecordBatch, n_fields: int) -> tuple[np.ndarray, list[str]]:
    """``row, field, token, position`` of each token of the last ``n_fields`` columns, and the distinct tokens.

    Every distinct word is folded once; of a word that is nothing but marks nothing is left.
    """
    named: dict[str, int] = {}
    found = []
    for field, column in enumerate(part.columns[-n_fields:]):
        words = column.flatten().dictionary_encode()
        codes = np.array([named.setdefault(w, len(named)) if w else -1 for w in (w.translate(FOLDING) for w in words.dictionary.to_pylist())], np.int32)
        code = codes[np.asarray(words.indices)]
        row = np.repeat(np.arange(part.num_rows, dtype=np.int32), np.asarray(pyarrow.compute.list_value_length(column), np.int64))
        row, code = row[code >= 0], code[code >= 0]
        position = np.arange(len(row), dtype=np.int32) - np.searchsorted(row, np.arange(part.num_rows)).astype(np.int32)[row]
        found.append(np.stack([row, np.full_like(row, field), code, position]))
    return np.concatenate(found, axis=1), list(named)


def _postings_of(carried: list[pa.Array], occurrences: np.ndarray, named: list[str], fields: tuple[str, ...]) -> list[pa.Array]:
    """The columns ``id, *keep, field, token, positions`` of one slice, by token, row and field."""
    named_once = pa.array(named, pa.string()).dictionary_encode()
    spelled = named_once.dictionary
    rank = np.empty(len(spelled), np.int64)
    by_name = np.asarray(pyarrow.compute.sort_indices(spelled))
    rank[by_name] = np.arange(len(spelled))
    row, field, code, position = occurrences
    n_rows, n_fields = len(carried[0]), len(fields)
    group = (rank[np.asarray(named_once.indices)][code] * n_rows + row) * n_fields + field
    order = np.lexsort((position, group)) if len(spelled) < len(named) else np.argsort(group, kind="stable")
    group = group[order]
    first = np.flatnonzero(np.diff(group, prepend=-1))
    token, rest = np.divmod(group[first], n_rows * n_fields)
    rows, in_field = np.divmod(rest, n_fields)
    ends = np.append(first, len(group)).astype(np.int32)
    return [
        *(column.take(pa.array(rows)) for column in carried), pa.array(fields, pa.string()).take(pa.array(in_field)),
        spelled.take(pa.array(by_name[token])), pa.ListArray.from_arrays(pa.array(ends), pa.array(position[order]))]


def _all_postings(df: DataFrame, key: str, fields: tuple[str, ...], stem: bool, keep: tuple[str, ...]) -> DataFrame:
    """:func:`build_postings` of every token, by slices of rows: numbers are sorted, strings only where they differ.

    Stems are taken between two passes over the slices, once for each distinct token of a slice.
    """
    carried = df.select(F.col(key).alias("id"), *keep)
    worded = df.select(F.col(key).alias("id"), *keep, *(marked_words(F.col(f)).alias(f"words_of_{n}") for n, f in enumerate(fields)))
    schema = T.StructType([
        *carried.schema.fields, T.StructField("field", T.StringType()), T.StructField("token", T.StringType()),
        T.StructField("positions", T.ArrayType(T.IntegerType()))])
    names, n_fields, n_carried = schema.names, len(fields), len(carried.columns)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _word_slices(batches, n_fields):
            yield pa.RecordBatch.from_arrays(_postings_of(part.columns[:n_carried], *_occurrences(part, n_fields), fields), names)

    if not stem:
        return worded.mapInArrow(whole, schema)

    def in_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _word_slices(batches, n_fields):
            occurrences, named = _occurrences(part, n_fields)
            kept, sink = part.select(list(range(n_carried))), pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, kept.schema) as out:
                out.write_batch(kept)
            yield pa.RecordBatch.from_pydict({
                "carried": pa.array([sink.getvalue().to_pybytes()], pa.binary()), "occurrences": pa.array([occurrences.tobytes()], pa.binary()),
                "words": pa.array([named], pa.list_(pa.string()))})

    def in_stems(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                (kept,) = pa.ipc.open_stream(batch.column(0)[k].as_buffer())
                occurrences = np.frombuffer(batch.column(1)[k].as_buffer(), np.int32).reshape(4, -1)
                yield pa.RecordBatch.from_arrays(_postings_of(kept.columns, occurrences, batch.column(2)[k].as_py(), fields), names)

    sliced = worded.mapInArrow(in_words, "carried binary, occurrences binary, words array<string>")
    return sliced.select("carried", "occurrences", stems("words").alias("words")).mapInArrow(in_stems, schema)


def build_postings(
    df: DataFrame,
    key: str = "id",
    fields: tuple[str, ...] = ("id", "description"),
    stem: bool = False,
    only: list[str] | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row ``(id, field, token, positions)`` per token, field and row of ``df``, with its columns ``keep``.

    Positions are grouped where the text is, so nothing is shuffled however often a token occurs: all tokens by
    slices of rows (:func:`_all_postings`). ``only`` keeps just the tokens a search asks for, few of a row, before they
    are grouped inside it; it holds stems when ``stem`` is set.
    """
    if only is None:
        return _all_postings(df, key, fields, stem, keep)
    wanted = _wanted(only, stem)
    per_field = F.array(*(F.struct(F.lit(f).alias("field"), tokens(F.col(f)).alias("words")) for f in fields))
    df = df.select(F.col(key).alias("id"), *keep, F.inline(per_field))

    def occurrence(word: Column, i: Column) -> Column:
        return F.struct(word.alias("token"), F.array(i).alias("positions"))

    occurrences = F.filter(F.transform("words", occurrence), lambda o: wanted(o["token"]))
    df = _grouped(df.select("id", *keep, "field", F.sort_array(occurrences).alias("occurrences")), keep)
    if stem:
        df = df.select("id", *keep, "field", "runs", stems("runs.token").alias("stems"))
        stemmed = F.zip_with(
            "stems", "runs", lambda s, r: F.struct(s.alias("token"), r["positions"].alias("positions"))
        )
        stemmed = F.filter(stemmed, lambda o: o["token"].isin(only))
        df = _grouped(df.select("id", *keep, "field", F.sort_array(stemmed).alias("occurrences")), keep)
    # The outer form keeps the optimizer from inferring a filter on the number of runs, which it
    # would evaluate by nesting all of the above into itself.
    return df.select("id", *keep, "field", F.inline_outer("runs")).filter(F.col("token").isNotNull())


def write_postings(postings: DataFrame, path: str, partitions: int | None = None) -> DataFrame:
    """Store postings for search by token and read them back.

    Ranges over ``(token, id)`` keep each token in few files while a token that most texts
    hold is spread over many of them; sorted row groups and the bloom filter let a search skip
    everything that cannot hold its tokens.
    """
    keys = ["token", "id"]
    with staged(postings, "postings") as rows:
        ranged = rows.repartitionByRange(partitions, *keys) if partitions else rows.repartitionByRange(*keys)
        (
            ranged.sortWithinPartitions(*keys)
            .write.mode("overwrite")
            .option("compression", "zstd")
            .option("parquet.bloom.filter.enabled#token", "true")
            .parquet(path)
        )
    return postings.sparkSession.read.parquet(path)


def query_tokens(spark: SparkSession, terms: list[str], stem: bool = False) -> list[list[str]]:
    """The tokens of each search term, through the same functions as the indexed text.

    The terms are literals, so the optimizer evaluates all of it and no job runs.
    """
    values = ", ".join(f"({n}, :t{n})" for n in range(len(terms)))
    given = spark.sql(f"SELECT * FROM VALUES {values} AS t(n, term)", {f"t{n}": t for n, t in enumerate(terms)})
    words = given.select("n", tokens(F.col("term")).alias("words"))
    if stem:
        words = words.select("n", stems("words").alias("words"))
    return [row.words for row in sorted(words.collect(), key=lambda row: row.n)]
