"""Benchmark passages in documents, in any order: shared seeds, then greedy string tiling.

Tokens are runs of letters and digits of the lower-cased text. A document and a benchmark item that share a
seed (``least`` tokens in a row) are tiled: by running Karp-Rabin hashes the longest common runs of tokens
not marked yet are found, compared token by token and marked, again and again with shorter runs down to
``least``. The share of the item's tokens inside tiles is its coverage; since tiles may lie anywhere, an
item whose sentences were put in another order is still covered.

A tile is made of seeds, so only the document's tokens inside shared seeds take part in tiling. A benchmark of at
most ``BLOCK_BYTES`` of text goes to every task: documents are read once and never shuffled, so a passage that a
third of them hold costs no more than any other. A larger one stays a table and documents are still read once: their
seeds that a filter of a fixed size does not rule out are joined with the items' seeds, and the places that a
document and an item share are tiled together. What the document's tokens are is known from the item's. Both ways
give the same rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vulnatlas.llm.text import combined, free_name, id_and_text, in_slices, mixed, slices, span_hashes, stored

LEAST = 5
#: Percent of an item's tokens inside tiles from which a document counts as contaminated.
COVERED = 50
#: Bytes of benchmark text that a task holds.
BLOCK_BYTES = 16_000_000
#: Bits of the filter of a larger benchmark's seeds, as a power of two.
FILTER_BITS = 26

_PART = np.zeros(256, dtype=bool)
_PART[48:58] = _PART[65:91] = _PART[97:123] = _PART[128:] = True
_PRIME, _FACTOR = (1 << 61) - 1, 1_000_003


def token_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and end of each token, and the number of tokens before each text, with the total at last."""
    part = _PART[data]
    edges = np.zeros(len(data) + 1, bool)
    edges[offsets] = True
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = part
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edges[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | edges[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def tokens_of(texts: list[str]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """All lower-cased texts as bytes, with the spans of :func:`token_spans`."""
    raw = [t.lower().encode("utf-8", "replace") for t in texts]
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in raw], dtype=np.int64)))
    data = b"".join(raw)
    return data, *token_spans(np.frombuffer(data, np.uint8), offsets)


def _run_hashes(tokens: list[int], marked: list[bool], length: int) -> Iterator[tuple[int, int]]:
    """Place and running Karp-Rabin hash of every run of ``length`` unmarked tokens."""
    drop = pow(_FACTOR, length, _PRIME)
    value = have = 0
    for k, token in enumerate(tokens):
        if marked[k]:
            value = have = 0
            continue
        value = (value * _FACTOR + token) % _PRIME
        have += 1
        if have > length:
            value = (value - tokens[k - length] * drop) % _PRIME
        if have >= length:
            yield k - length + 1, value


def greedy_tiles(item: list[bytes], text: list[bytes], least: int) -> list[tuple[int, int, int]]:
    """``(place in item, place in text, length)`` of the tiles: longest first, of equal length the earliest."""
    codes: dict[bytes, int] = {}
    p, t = ([codes.setdefault(w, len(codes) + 1) for w in side] for side in (item, text))
    marked_p, marked_t = [False] * len(p), [False] * len(t)

    def common(a: int, b: int) -> int:
        k = 0
        while a + k < len(p) and b + k < len(t) and p[a + k] == t[b + k] and not marked_p[a + k] and not marked_t[b + k]:
            k += 1
        return k

    tiles, length = [], max(least, 16)
    while True:
        places = defaultdict(list)
        for b, value in _run_hashes(t, marked_t, length):
            places[value].append(b)
        found = [
            (common(a, b), a, b) for a, value in _run_hashes(p, marked_p, length) for b in places.get(value, ())
        ]
        longest = max((k for k, _, _ in found), default=0)
        if longest > 2 * length:
            length = longest  # far longer runs exist: mark those first
            continue
        for k, a, b in sorted(((k, a, b) for k, a, b in found if k >= length), key=lambda m: (-m[0], m[1], m[2])):
            if (k := min(k, common(a, b))) < length:
                continue
            marked_p[a:a + k] = [True] * k
            marked_t[b:b + k] = [True] * k
            tiles.append((a, b, k))
        if length <= least:
            return tiles
        length = max(least, length // 2)


class Block:
    """Benchmark items of a bounded size: their tokens, and which of them hold each seed."""

    def __init__(self, items: list[tuple[int, str]], least: int):
        self.least = least
        self.items: list[tuple[int, list[bytes]]] = []
        self.short: dict[int, list[int]] = defaultdict(list)
        keys, owners = [], []
        data, starts, ends, first = tokens_of([text for _, text in items])
        hashes = span_hashes(np.frombuffer(data, np.uint8), starts, ends)
        for k, (item_id, _) in enumerate(items):
            spans = zip(starts[first[k]:first[k + 1]].tolist(), ends[first[k]:first[k + 1]].tolist(), strict=True)
            tokens = [data[a:b] for a, b in spans]
            if not tokens:
                continue
            width = min(least, len(tokens))
            seeds = np.unique(combined(hashes[first[k]:first[k + 1]], width))
            if width < least:
                self.short[width].append(len(self.items))
            keys.append(seeds)
            owners.append(np.full(len(seeds), len(self.items)))
            self.items.append((item_id, tokens))
        keys = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        owners = np.concatenate(owners) if owners else np.zeros(0, np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.owners = keys[order], owners[order]

    def best(self, texts: list[str]) -> list[tuple[int, int, int, int]]:
        """For each text how many items it covers by ``COVERED`` or more, and the best covered item with its tiles' and all tokens."""
        data, starts, ends, first = tokens_of(texts)
        hashes = span_hashes(np.frombuffer(data, np.uint8), starts, ends)
        spots = defaultdict(lambda: defaultdict(list))
        for width in {self.least, *self.short}:
            runs = combined(hashes, width)
            low = np.searchsorted(self.keys, runs, side="left")
            for at in np.flatnonzero((low < len(self.keys)) & (self.keys[np.minimum(low, len(self.keys) - 1)] == runs)) if len(self.keys) else ():
                text = int(np.searchsorted(first, at, side="right")) - 1
                if at + width > first[text + 1]:
                    continue
                k = int(low[at])
                while k < len(self.keys) and self.keys[k] == runs[at]:
                    owner = int(self.owners[k])
                    if min(self.least, len(self.items[owner][1])) == width:
                        spots[text][owner].append((int(at), int(at) + width))
                    k += 1
        out = [(0, None, 0, 0)] * len(texts)
        for text, owners in spots.items():
            found = []
            for owner, places in owners.items():
                item_id, item = self.items[owner]
                tokens, end = [], -1
                for a, b in places:
                    if a > end >= 0:
                        tokens.append(b"")  # a gap: no tile runs across it
                    tokens.extend(data[starts[k]:ends[k]] for k in range(max(a, end), b))
                    end = b
                tiled = sum(k for _, _, k in greedy_tiles(item, tokens, min(self.least, len(item))))
                found.append((-tiled / len(item), item_id, tiled, len(item)))
            covered = sum(100 * tiled >= COVERED * size for _, _, tiled, size in found)
            out[text] = (covered, *min(found)[1:])
        return out


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """``item_id, text``; null ids and texts are left out."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    return rows.filter("item_id IS NOT NULL AND text IS NOT NULL")


def one_block(items: DataFrame, least: int) -> Block | None:
    """The items as one block, if their texts are within ``BLOCK_BYTES``."""
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return Block([(r.item_id, r.text) for r in items.collect()], least) if size <= BLOCK_BYTES else None


def _seeds(texts: list[str], widths: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``text, place, seed, check`` of the seeds of each width: two hashes of 64 bits of its tokens, the width part of the first."""
    data, starts, ends, first = tokens_of(texts)
    hashes = span_hashes(np.frombuffer(data, np.uint8), starts, ends)
    for width in widths:
        seed, check = combined(hashes, width) + np.uint64(width), combined(mixed(hashes), width)
        owner = np.searchsorted(first, np.arange(len(seed)), side="right") - 1
        whole = np.flatnonzero(np.arange(len(seed)) + width <= first[owner + 1]) if len(seed) else np.zeros(0, np.int64)
        yield owner[whole], whole - first[owner[whole]], seed[whole].view(np.int64), check[whole].view(np.int64)


def _joined(rows: DataFrame, items: DataFrame, least: int) -> DataFrame:
    """``row, n_items, b`` of the ``rows`` (row, text) that share a seed with an item; b is the best of them."""
    keyed = stored(items.withColumn("item", F.monotonically_increasing_id()), "items")

    def item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = part.column("text").to_pylist()
            first = tokens_of(texts)[3]
            size = np.diff(first)
            for width in range(1, least + 1):
                own = np.flatnonzero(size >= least if width == least else size == width)
                for text, place, seed, check in _seeds([texts[k] for k in own], [width]):
                    item = part.column("item").to_numpy()[own[text]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(item), pa.array(place, pa.int32()), pa.array(seed), pa.array(check), pa.array(np.full(len(seed), width), pa.int32())],
                        names=["item", "at", "seed", "check", "width"])

    found = keyed.mapInArrow(item_seeds, "item long, at int, seed long, check long, width int")
    # One place of each seed in an item is enough to know its tokens.
    seeds = stored(found.groupBy("item", "seed", "check", "width").agg(F.min("at").alias("at")), "seeds")
    widths = sorted(r.width for r in seeds.select("width").distinct().collect())
    bit = F.pmod("seed", F.lit(1 << FILTER_BITS))
    words = seeds.groupBy(F.floor(bit / 64).cast("int").alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), (bit % 64).cast("int"))).alias("bits"))
    table = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    for word, bits in words.collect():  # no more than the table has words
        table[word] = bits
    table = table.view(np.uint64)

    def row_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            for text, place, seed, check in _seeds(part.column("text").to_pylist(), widths):
                at = seed.astype(np.int64) % (1 << FILTER_BITS)
                may = np.flatnonzero((table[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part.column("row").to_numpy()[text[may]]), pa.array(place[may], pa.int32()), pa.array(seed[may]), pa.array(check[may])],
                    names=["row", "place", "seed", "check"])

    shared = rows.mapInArrow(row_seeds, "row long, place int, seed long, check long").join(seeds, ["seed", "check"])
    pairs = shared.groupBy("row", "item").agg(F.collect_list(F.struct("place", "at", "width")).alias("spots")).join(keyed, "item")

    def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spots in zip(batch.column("text").to_pylist(), batch.column("spots").to_pylist(), strict=True):
                data, starts, ends, _ = tokens_of([text])
                item = [data[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                tokens, end = [], -1
                for spot in sorted(spots, key=lambda s: s["place"]):
                    place, at, width = spot["place"], spot["at"], spot["width"]
                    if place > end >= 0:
                        tokens.append(b"")  # a gap: no tile runs across it
                    fresh = max(place, end)
                    tokens.extend(item[at + fresh - place:at + width])
                    end = place + width
                out.append((sum(k for _, _, k in greedy_tiles(item, tokens, min(least, len(item)))), len(item)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("item_id"), *(pa.array(c, pa.int64()) for c in zip(*out, strict=True))] if out else
                [batch.column("row"), batch.column("item_id"), pa.array([], pa.int64()), pa.array([], pa.int64())],
                names=["row", "item_id", "n_tiled", "n_tokens"])

    tiled = pairs.select("row", "item_id", "text", "spots").mapInArrow(tile, "row long, item_id long, n_tiled long, n_tokens long")
    best = F.max_by(F.struct("item_id", "n_tiled", "n_tokens"), F.struct(F.col("n_tiled") / F.col("n_tokens"), -F.col("item_id"), -F.col("n_tiled")))
    covered = F.sum((100 * F.col("n_tiled") >= COVERED * F.col("n_tokens")).cast("long"))
    return tiled.groupBy("row").agg(covered.alias("n_items"), best.alias("b"))


def contamination(docs: DataFrame, benchmark: DataFrame, least: int = LEAST) -> DataFrame:
    """``doc_id, contaminated, n_items, item_id, n_tiled, n_tokens`` for every row of ``docs`` (doc_id, text).

    ``n_items`` items are covered by at least ``COVERED`` percent; ``item_id`` is the best covered item that
    shares a seed (of equal ones the smallest), ``n_tiled`` of its ``n_tokens`` tokens lie in tiles; null and
    0 where none shares a seed. An item shorter than a seed has to occur whole. A text or item that is null,
    empty or without tokens matches nothing; so does an empty benchmark. Repeated items count each. Repeated
    rows and rows without an id get a row each, for any size of the benchmark: for a large one, the rows are stored
    with a key first. Other columns are ignored.
    """
    rows, items = id_and_text(docs), benchmark_items(benchmark)
    block = one_block(items, least)
    if block is None:
        keyed = stored(rows.withColumn("row", F.monotonically_increasing_id()), "keyed_rows")
        found = keyed.select("row", "doc_id").join(_joined(keyed, items, least), "row", "left")
        zero = F.lit(0).cast("long")
        found = found.select(
            "doc_id", F.coalesce("n_items", zero).alias("n_items"), F.col("b.item_id").alias("item_id"),
            *(F.coalesce(F.col(f"b.{name}"), zero).alias(name) for name in ("n_tiled", "n_tokens")))
    else:
        def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in slices(batches):
                columns = [pa.array(c, pa.int64()) for c in zip(*block.best(part.column("text").to_pylist()), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], names=["doc_id", "n_items", "item_id", "n_tiled", "n_tokens"])

        found = rows.mapInArrow(match, "doc_id long, n_items long, item_id long, n_tiled long, n_tokens long")
    return found.select("doc_id", (F.col("n_items") > 0).alias("contaminated"), "n_items", "item_id", "n_tiled", "n_tokens")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, least: int = LEAST) -> DataFrame:
    """The rows of ``docs`` whose text covers no benchmark item, with all their columns.

    Each row is judged by its own text; null and empty ones stay, and so does everything with an empty benchmark.
    """
    items = benchmark_items(benchmark)
    block = one_block(items, least)
    if block is None:
        key = free_name(docs.columns, "row_key")
        keyed = stored(docs.withColumn(key, F.monotonically_increasing_id()), "keyed_rows")
        rows = keyed.select(F.col(key).alias("row"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
        gone = _joined(rows, items, least).filter("n_items > 0").select(F.col("row").alias(key))
        return keyed.join(gone, key, "left_anti").select(docs.columns)

    @F.pandas_udf("boolean")
    def clean(texts):
        return texts.__class__([n == 0 for n, *_ in in_slices([t or "" for t in texts], block.best)])

    return docs.filter(clean(docs["text"].cast("string")))
