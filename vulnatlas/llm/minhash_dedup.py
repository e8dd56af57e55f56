"""Near-duplicate documents: banded MinHash candidates, verified sequentially by Bayesian bounds, then exactly.

1. Every text becomes its set of word shingles (ASCII letters lower-cased), a MinHash signature and
   band keys. Texts with the same words are one class, which its smallest ``doc_id`` stands for.
2. A band's bucket of classes meets a few of its own members (its leaders) instead of all pairs.
3. A candidate pair is compared by batches of its signature. With a uniform prior on the similarity,
   ``m`` equal values of ``n`` leave P(similarity >= threshold) = P(Binomial(n + 1, threshold) <= m);
   a pair is pruned once that falls below ``miss``, the chosen probability of losing a link.
4. Survivors are confirmed on their full shingle sets.
5. Pairs inside one component cannot change it. So after the leaders' links are joined to components,
   only those pairs of a bucket are still considered whose components differ: all of them in a small
   bucket, those that an exact prefix join leaves in a large one. No bucket is capped or sampled.

A third of all rows may be copies of one text: equal texts of a slice send one signature, classes are
formed with a map-side combine, and every join is one that adaptive execution can split.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vulnatlas.llm.components import connected_components
from vulnatlas.llm.text import LOWER, combined, free_name, id_and_text, mixed, scratch, slices, span_hashes, stored, text_bytes, word_spans

BANDS, ROWS = 20, 4  # a pair at a similarity of 0.8 shares no band with a probability of 3e-5
HASHES = 128
BATCH = 16
LEADERS = 2
#: Ids of documents in shared buckets up to which they are broadcast to pick their texts.
BROADCAST_IDS = 1_000_000
#: Bitmaps of rows that go, 4 KB each, up to which they are broadcast.
BROADCAST_BITMAPS = 16_000
#: Buckets of at most so many members compare all pairs of different components; larger ones join by prefixes.
SMALL = 32
MISS = 1e-6

_random = np.random.default_rng(20240501)
_FLIP = _random.integers(0, 1 << 32, (HASHES, 1), dtype=np.uint32)
_TIMES = _random.integers(0, 1 << 32, (HASHES, 1), dtype=np.uint32) | np.uint32(1)
_BAND_SEEDS = _random.integers(0, 1 << 64, BANDS, dtype=np.uint64)

SIGNED = pa.schema([
    ("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("fp", pa.binary()),
    ("signature", pa.binary()),
])


def signature(hashes: np.ndarray) -> np.ndarray:
    """The smallest value of each of the ``HASHES`` hash functions over a set of 64-bit hashes."""
    low = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for k in range(0, len(low), 4096):
        np.minimum(least, ((low[None, k:k + 4096] ^ _FLIP) * _TIMES).min(axis=1), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of each signature (n, HASHES); the band's number is part of it."""
    rows = least[:, :BANDS * ROWS].reshape(-1, BANDS, ROWS).astype(np.uint64)
    key = np.tile(_BAND_SEEDS, (len(rows), 1))
    for k in range(ROWS):
        key = mixed(key * np.uint64(0xD6E8FEB86659FD93) + rows[:, :, k])
    return key.view(np.int64)


def banded(signatures: DataFrame) -> DataFrame:
    """``rep, band``: a row for each band of each signature."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = band_keys(_signatures(batch.column("signature")))
                reps = np.repeat(batch.column("rep").to_numpy(), BANDS)
                yield pa.RecordBatch.from_arrays([pa.array(reps), pa.array(found.ravel())], names=["rep", "band"])

    return signatures.select("rep", "signature").mapInArrow(keys, "rep long, band long")


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, HASHES)


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Distinct shingle hashes of a text's word hashes; a text of fewer words is one shingle."""
    return np.unique(combined(words, min(width, len(words)) or 1))


def text_shingles(text: bytes, width: int) -> set[bytes]:
    """The full shingle set itself, for confirming links."""
    words = text.lower().split()
    width = min(width, len(words)) or 1
    return {b" ".join(words[k:k + width]) for k in range(len(words) - width + 1)}


def least_matches(threshold: float, miss: float) -> dict[int, int]:
    """Equal values that a pair needs after each batch so as not to be pruned."""

    def still_possible(m: int, n: int) -> float:
        return sum(comb(n + 1, k) * threshold**k * (1 - threshold) ** (n + 1 - k) for k in range(m + 1))

    return {n: next(m for m in range(n + 1) if still_possible(m, n) >= miss) for n in range(BATCH, HASHES + 1, BATCH)}


def signed_documents(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, n_shingles, fp, signature``; the last only at the first of equal texts of a slice."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            data, offsets = text_bytes(part.column("text"))
            data = LOWER[data]
            starts, ends, first = word_spans(data, offsets)
            hashes = span_hashes(data, starts, ends)
            sizes, marks, signatures, seen = [], [], [], {}
            raw = data.tobytes()
            for k in range(part.num_rows):
                words = hashes[first[k]:first[k + 1]]
                if not len(words):
                    sizes.append(0), marks.append(None), signatures.append(None)
                    continue
                same = b" ".join(raw[offsets[k]:offsets[k + 1]].split())
                mark = hashlib.blake2b(same, digest_size=16).digest()
                marks.append(mark)
                if mark in seen:
                    sizes.append(seen[mark]), signatures.append(None)
                    continue
                grams = shingle_hashes(words, width)
                seen[mark] = len(grams)
                sizes.append(len(grams)), signatures.append(signature(grams).tobytes())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(marks, pa.binary()),
                 pa.array(signatures, pa.binary())], schema=SIGNED)

    return id_and_text(docs).mapInArrow(sign, "doc_id long, n_shingles long, fp binary, signature binary")


def _pruned(pairs: DataFrame, threshold: float, miss: float) -> DataFrame:
    """Pairs (a, b, sa, sb) whose posterior does not rule the threshold out at any batch."""
    needed = least_matches(threshold, miss)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = _signatures(batch.column("sa")), _signatures(batch.column("sb"))
            alive, equal = np.arange(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            for n in range(BATCH, HASHES + 1, BATCH):
                equal[alive] += (left[alive, n - BATCH:n] == right[alive, n - BATCH:n]).sum(axis=1)
                alive = alive[equal[alive] >= needed[n]]
            kept = batch.take(pa.array(alive))
            yield pa.RecordBatch.from_arrays([kept.column("a"), kept.column("b")], names=["a", "b"])

    return pairs.mapInArrow(compare, "a long, b long")


def _confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs whose full sets have 100 * intersection >= percent * union."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, grams = None, set()
        for batch in batches:
            good = []
            for a, b in zip(batch.column("ta"), batch.column("tb"), strict=True):
                if (text := a.as_buffer().to_pybytes()) != last:
                    last, grams = text, text_shingles(text, width)
                other = text_shingles(b.as_buffer().to_pybytes(), width)
                shared = len(grams & other)
                good.append(100 * shared >= percent * (len(grams) + len(other) - shared))
            kept = batch.filter(pa.array(good, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column("a"), kept.column("b")], names=["a", "b"])

    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "ta", "tb").mapInArrow(check, "a long, b long")


def _prefix_pairs(spots: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs of members of large buckets that may still link two components, by an exact prefix join.

    ``spots`` (rep, component, band). Sets are ordered by how rare their shingles are among all members.
    Two sets of ``x`` and ``y`` shingles that share ``need = ceil(percent * (x + y) / (100 + percent))``
    share one at places ``i, j`` with ``min(x - i, y - j) + 1 >= need``. A pair of different components
    has a member outside the most frequent component of its bucket, so only those members ask.
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            data, offsets = text_bytes(part.column("text"))
            data = LOWER[data]
            starts, ends, first = word_spans(data, offsets)
            hashes = span_hashes(data, starts, ends)
            sets = [shingle_hashes(hashes[first[k]:first[k + 1]], width).view(np.int64) for k in range(part.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [part.column("rep"), part.column("component"), pa.array(sets, pa.list_(pa.int64()))], names=["rep", "component", "grams"])

    usual = spots.groupBy("band").agg(F.mode("component").alias("usual"))
    asking = spots.join(usual, "band").filter("component <> usual").select("rep").distinct()
    members = spots.select("rep", "component").distinct()
    sets = texts.join(members, texts["doc_id"] == members["rep"]).select("rep", "component", "text").mapInArrow(
        spread, "rep long, component long, grams array<long>")
    grams = stored(sets.select("rep", "component", F.size("grams").alias("n"), F.explode("grams").alias("gram")), "grams")
    places = Window.partitionBy("rep").orderBy("held", "gram")
    ranked = (
        grams.join(grams.groupBy("gram").agg(F.count(F.lit(1)).alias("held")), "gram")
        .withColumn("place", F.row_number().over(places))
        .filter((F.col("place") <= F.col("n") - F.ceil(F.col("n") * percent / 100) + 1) & (F.col("held") > 1))
    )
    ranked = stored(ranked, "prefixes")
    one, two = ranked.join(asking, "rep", "left_semi").alias("one"), ranked.alias("two")
    need = F.ceil((F.col("one.n") + F.col("two.n")) * percent / (100 + percent))
    reach = F.least(F.col("one.n") - F.col("one.place"), F.col("two.n") - F.col("two.place")) + 1
    met = (F.col("one.gram") == F.col("two.gram")) & (F.col("one.component") != F.col("two.component")) & (reach >= need)
    return one.join(two, met).select(F.least("one.rep", "two.rep").alias("a"), F.greatest("one.rep", "two.rep").alias("b"))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, miss: float = MISS) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs`` (doc_id, text).

    Rows with the same words are linked, and those whose sets of ``width``-word shingles share at least
    ``percent`` of their union. Texts that are null, empty or white space have no shingle, no link and
    stay. Rows that repeat a ``doc_id`` get a row each, linked by their own words; texts whose smallest
    ``doc_id`` is the same are linked. A row without a ``doc_id`` is never linked, its ``component_id`` is
    null, and it stays. The smallest ``doc_id`` of a component stays, so ties do not arise. Other columns are ignored.
    """
    signed = stored(signed_documents(docs, width), "signed")
    known = signed.filter("doc_id IS NOT NULL AND fp IS NOT NULL")
    carrier = F.when(F.col("signature").isNotNull(), F.col("doc_id"))
    classes = stored(known.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.min_by("signature", carrier).alias("signature")), "classes")

    # Most bands hold one class alone; only the others are kept.
    members = banded(classes)
    shared = members.groupBy("band").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    spots = stored(members.join(shared, "band").select("rep", "band", "n"), "spots")
    hot = stored(spots.groupBy("rep").agg(F.sum("n").alias("met")), "hot")
    few = hot.count() <= BROADCAST_IDS
    small = F.broadcast(hot) if few else hot
    signatures = stored(classes.select("rep", "signature").join(small, "rep", "left_semi"), "signatures")
    ids = small.select(F.col("rep").alias("doc_id"))
    texts = stored(id_and_text(docs).filter("doc_id IS NOT NULL").join(ids, "doc_id", "left_semi"), "texts")

    def links(pairs: DataFrame) -> DataFrame:
        left = signatures.select(F.col("rep").alias("a"), F.col("signature").alias("sa"))
        right = signatures.select(F.col("rep").alias("b"), F.col("signature").alias("sb"))
        alive = stored(_pruned(pairs.join(right, "b").join(left, "a").select("a", "b", "sa", "sb"), percent / 100, miss).distinct(), "pairs")
        return stored(_confirmed(alive, texts, width, percent).distinct(), "links")

    # The text that others were made from meets most of them, and is linked to most.
    chosen = [F.min_by("rep", F.struct(-F.col("met"), "rep"))] + [F.min_by("rep", F.xxhash64("rep", F.lit(k))) for k in range(1, LEADERS)]
    leaders = spots.join(small, "rep").groupBy("band").agg(F.array_distinct(F.array(*chosen)).alias("leaders"))
    met = (
        spots.select("rep", "band").join(leaders, "band")
        .select("rep", F.explode("leaders").alias("leader")).filter("rep <> leader")
        .select(F.least("rep", "leader").alias("a"), F.greatest("rep", "leader").alias("b")).distinct()
    )
    first = links(met)
    joined = stored(connected_components(first), "components")

    placed = stored(
        spots.join(joined.withColumnRenamed("node", "rep"), "rep", "left")
        .select("rep", F.coalesce("component", "rep").alias("component"), "band", "n"), "placed")
    parted = placed.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high")
    open_spots = placed.join(parted.select("band"), "band", "left_semi")
    near = open_spots.filter(F.col("n") <= SMALL)
    one, two = near.alias("one"), near.alias("two")
    rest = one.join(two, (F.col("one.band") == F.col("two.band")) & (F.col("one.component") < F.col("two.component"))).select(
        F.least("one.rep", "two.rep").alias("a"), F.greatest("one.rep", "two.rep").alias("b")
    )
    large = stored(open_spots.filter(F.col("n") > SMALL), "large")
    if not large.isEmpty():
        rest = rest.union(_prefix_pairs(large, texts, width, percent))
    second = links(rest.distinct())
    joined = connected_components(first.union(second))

    named = classes.select("fp", "rep").join(joined.withColumnRenamed("node", "rep"), "rep", "left").select(
        "fp", F.coalesce("component", "rep").alias("linked"))
    found = signed.select("doc_id", "n_shingles", "fp").join(named, "fp", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("linked", "doc_id"))
    return found.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")
    )


def _without(keyed: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """The rows of ``keyed`` whose ``key`` is not in ``gone``; keys are distinct and not negative.

    Bitmaps of 32,768 keys name the rows that go, so that these are broadcast, a bit each, and no text is shuffled.
    """
    bucket, bits = (free_name(keyed.columns, name) for name in ("key_bucket", "key_bits"))
    marks = gone.groupBy(F.bitmap_bucket_number(key).alias(bucket)).agg(F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias(bits))
    marks = stored(marks, "marks")
    marks = F.broadcast(marks) if marks.count() <= BROADCAST_BITMAPS else marks
    place = F.bitmap_bit_position(key)
    byte = F.conv(F.hex(F.substring(bits, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    goes = F.coalesce(F.call_function("shiftright", byte, (place % 8).cast("int")) % 2 == 1, F.lit(False))
    return keyed.join(marks, F.bitmap_bucket_number(key) == F.col(bucket), "left").filter(~goes)


def drop_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without near copies of others, with all their columns: one row of each group stays.

    Rows are linked by their own words, as in :func:`near_duplicates`, whatever their ``doc_id``: a row goes only
    if it is itself a near copy, and rows that repeat an id, or have none, are compared like any others. Of a
    group the row with the smallest ``doc_id`` stays, one without an id only if all lack it, and of equal ids
    any one row. Rows whose text is null, empty or white space all stay. The rows are stored once with a key.
    """
    key = free_name(docs.columns, "row_key")
    keyed = stored(docs.withColumn(key, F.monotonically_increasing_id()), "keyed")
    with scratch(docs.sparkSession):  # signatures, texts and links are not asked for again
        found = near_duplicates(keyed.select(F.col(key).alias("doc_id"), "text"), width, percent)
        found = stored(found.select(F.col("doc_id").alias("row"), F.col("component_id").alias("group"), "kept"), "found", keep=True)
    groups = found.filter("NOT kept").select("group").distinct()
    ids = keyed.select(F.col(key).alias("row"), F.col("doc_id").cast("long").alias("id"))
    members = stored(found.join(groups, "group", "left_semi").join(ids, "row").select("row", "group", "id"), "members")
    stays = members.groupBy("group").agg(F.min_by("row", F.struct(F.col("id").isNull(), "id", "row")).alias("row"))
    gone = members.join(stays, ["group", "row"], "left_anti").select(F.col("row").alias(key))
    return _without(keyed, gone, key).select(docs.columns)
