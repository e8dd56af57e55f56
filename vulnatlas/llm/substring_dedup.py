"""Repeated passages: windows of words travel as packed runs that share a minimiser, and are compared exactly.

A window is ``width`` consecutive words of one document. Its minimiser is the smallest hash among its runs
of ``seed`` words. Consecutive windows with the same minimiser are sent as one string (a super-k-mer) to
the bucket of that minimiser, so equal windows always meet, and a word is sent about three times instead
of ``width`` times. The strings of a task for a bucket are compressed together. In a bucket, sorting brings
equal window hashes together; those windows are then compared as strings, so no hash decides.

Buckets follow the data: a first pass adds up what each slot of minimisers will send. There are as many buckets
as keep each near ``BUCKET_BYTES``, and a slot that sends more by itself, such as that of a minimiser that a third
of all rows hold, is split into several by the hash of the window; equal windows still meet.

Hot passages: a task sends an equal string once, unless a smaller document holds it later; the others are
already known to repeat it. A passage that a third of all rows hold so reaches its bucket once per task, not
once per row. A bucket is worked on in as many ranges of window hashes as keep each at ``RANGE_BYTES`` of text,
so that beside the compressed strings only one range's hashes and its distinct repeated windows are held.

A row is known by its ``doc_id`` and a hash of its text, so that rows which repeat an id with another text are
judged and cut by their own words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vulnatlas.llm.text import combined, free_name, id_and_text, remove_stored, slices, span_hashes, stored, word_spans

WIDTH = 13
SEED = 4
#: Bytes of packed strings that a task compresses at a time.
SEND_BYTES = 24_000_000
#: Strings a task remembers so as not to send them again.
KNOWN = 200_000
#: Bytes of a bucket's strings whose windows are compared at a time.
RANGE_BYTES = 128_000_000
#: Bytes of strings that a bucket should hold.
BUCKET_BYTES = 64_000_000
#: Buckets for each shuffle partition, at least.
SPREAD = 4
#: Slots of minimisers for each bucket, and at least, whose bytes are added up.
SLOTS, LEAST_SLOTS = 4, 4096
#: Bytes of merged ranges up to which they are broadcast to their documents.
BROADCAST_BYTES = 32_000_000

SENT = pa.schema([
    ("bucket", pa.int64()), ("packed", pa.binary()), ("doc_id", pa.int64()), ("mark", pa.int64()), ("place", pa.int32()), ("count", pa.int32())])
RANGES = pa.schema([("doc_id", pa.int64()), ("mark", pa.int64()), ("place", pa.int32()), ("count", pa.int32())])
RANGE_COLUMNS = "doc_id long, mark long, place int, count int"


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` consecutive values, in a logarithmic number of steps."""
    have, out = 1, values
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:len(out) - step], out[step:])
        have += step
    return out


def marked(docs: DataFrame) -> DataFrame:
    """``doc_id, text, mark``: the mark is a hash of the text."""
    return id_and_text(docs).withColumn("mark", F.xxhash64("text"))


class _Words:
    """The words of a slice of texts, and the minimiser of the window that begins at each word."""

    def __init__(self, part: pa.RecordBatch, width: int, seed: int):
        words = [text.as_buffer().to_pybytes().split() for text in part.column("text").cast(pa.large_binary())]
        sizes = np.array([len(w) for w in words], np.int64)
        self.joined = b" ".join([b" ".join(w) for w in words if w])
        del words
        data = np.frombuffer(self.joined, np.uint8)
        self.starts, self.ends, _ = word_spans(data, np.array([0, len(data)]))
        self.hashes = span_hashes(data, self.starts, self.ends) if len(self.starts) >= width else np.zeros(0, np.uint64)
        self.least = sliding_least(combined(self.hashes, seed), width - seed + 1) if len(self.hashes) else self.hashes
        self.owner = np.repeat(np.arange(len(sizes)), sizes)[:len(self.least)]
        self.place = np.arange(len(self.least)) - (np.cumsum(sizes) - sizes)[self.owner]
        self.whole = self.place + width <= sizes[self.owner]
        self.width = width

    def runs(self, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last window of each stretch of windows in which the keys stay the same."""
        fresh = self.whole.copy()
        same = np.ones(max(0, len(fresh) - 1), bool)
        for key in keys:
            same &= key[1:] == key[:-1]
        fresh[1:] &= ~self.whole[:-1] | ~same
        return np.flatnonzero(fresh), np.flatnonzero(self.whole & ~np.append(self.whole[1:] & ~fresh[1:], False))


@dataclass(frozen=True)
class Buckets:
    """Where windows go: ``n`` buckets by minimiser; slots that are too heavy for one have several, by window."""

    n: int
    slots: int
    heavy: np.ndarray  # sorted slots
    parts: np.ndarray  # buckets of each

    def of(self, words: _Words) -> np.ndarray:
        """The bucket of the window that begins at each word."""
        out = (words.least % np.uint64(self.n)).astype(np.int64)
        if len(self.heavy):
            slot = ((words.least >> np.uint64(20)) % np.uint64(self.slots)).astype(np.int64)
            at = np.minimum(np.searchsorted(self.heavy, slot), len(self.heavy) - 1)
            chosen = np.flatnonzero(self.heavy[at] == slot)
            if len(chosen):
                first = self.n + np.cumsum(self.parts) - self.parts
                window = combined(words.hashes, words.width)[chosen]
                out[chosen] = first[at[chosen]] + (window % self.parts[at[chosen]].astype(np.uint64)).astype(np.int64)
        return out


def buckets_for(docs: DataFrame, width: int, seed: int) -> Buckets:
    """Buckets by what the slots of minimisers send; that is added up over all texts, by slot, in Spark."""
    spark = docs.sparkSession
    rows = id_and_text(docs).filter("doc_id IS NOT NULL")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slots = max(LEAST_SLOTS, 1 << (SLOTS * total // BUCKET_BYTES).bit_length())

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(slots, np.int64)
        for part in slices(batches):
            words = _Words(part, width, seed)
            first, last = words.runs(words.least)
            slot = ((words.least[first] >> np.uint64(20)) % np.uint64(slots)).astype(np.int64)
            np.add.at(sums, slot, words.ends[last + width - 1] - words.starts[first])
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(sums[used], pa.int64())], names=["slot", "bytes"])

    loads = stored(rows.mapInArrow(load, "slot long, bytes long").groupBy("slot").agg(F.sum("bytes").alias("bytes")), "loads")
    sent = loads.agg(F.sum("bytes")).first()[0] or 0
    heavy = loads.filter(F.col("bytes") > BUCKET_BYTES).orderBy("slot").collect()  # no more than sent // BUCKET_BYTES
    remove_stored(loads)
    n = max(SPREAD * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-sent // BUCKET_BYTES))
    return Buckets(n, slots, np.array([r.slot for r in heavy], np.int64), np.array([-(-r.bytes // BUCKET_BYTES) for r in heavy], np.int64))


def packed_runs(docs: DataFrame, width: int, seed: int, buckets: Buckets) -> DataFrame:
    """``bucket, packed``: compressed runs of windows; or ``doc_id, mark, place, count``: windows known to repeat."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[bytes]]] = []
        size = 0

        def send() -> pa.RecordBatch:
            bucket, doc, mark, place = (np.concatenate([part[k] for part in held]) for k in range(4))
            strings = [text for part in held for text in part[4]]
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
            shrink = zstandard.ZstdCompressor(level=3)
            packed = [
                shrink.compress(b"".join((
                    np.array([len(part)], "<i8").tobytes(), doc[part].astype("<i8").tobytes(), mark[part].astype("<i8").tobytes(),
                    place[part].astype("<i4").tobytes(), b"\n".join([strings[k] for k in part.tolist()]))))
                for part in np.split(order, cuts[1:])
            ]
            n = len(packed)
            return pa.RecordBatch.from_arrays(
                [pa.array(bucket[order[cuts]], pa.int64()), pa.array(packed, pa.binary()),
                 *(pa.nulls(n, kind) for kind in (pa.int64(), pa.int64(), pa.int32(), pa.int32()))], schema=SENT)

        for part in slices(batches):
            ids, marks = part.column("doc_id").to_numpy(), part.column("mark").to_numpy()
            words = _Words(part, width, seed)
            if not len(words.least):
                continue
            target = buckets.of(words)
            first, last = words.runs(words.least, target)
            doc, mark, place = ids[words.owner[first]], marks[words.owner[first]], words.place[first]
            strings = [words.joined[a:b] for a, b in zip(words.starts[first].tolist(), words.ends[last + width - 1].tolist(), strict=True)]
            repeats = np.zeros(len(first), bool)
            for k, (text, d) in enumerate(zip(strings, doc.tolist(), strict=True)):
                if (smallest := known.setdefault(text, d)) < d:
                    repeats[k] = True
                elif smallest > d:
                    known[text] = d
            if len(known) > KNOWN:
                known.clear()
            if repeats.any():
                n = int(repeats.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array((np.arange(n) + int(doc[0])) % buckets.n, pa.int64()), pa.nulls(n, pa.binary()), pa.array(doc[repeats]),
                     pa.array(mark[repeats]), pa.array(place[repeats], pa.int32()), pa.array((last - first + 1)[repeats], pa.int32())], schema=SENT)
            sent = [text for text, r in zip(strings, repeats.tolist(), strict=True) if not r]
            if sent:
                held.append((target[first][~repeats], doc[~repeats], mark[~repeats], place[~repeats], sent))
                size += sum(map(len, sent))
            if size >= SEND_BYTES:
                yield send()
                held.clear()
                size = 0
        if held:
            yield send()

    return marked(docs).filter("doc_id IS NOT NULL").mapInArrow(pack, f"bucket long, packed binary, {RANGE_COLUMNS}")


class _Windows:
    """The windows of one compressed batch of runs."""

    def __init__(self, packed: bytes, width: int):
        raw = zstandard.ZstdDecompressor().decompress(packed)
        (n,) = np.frombuffer(raw, "<i8", 1).tolist()
        self.doc, self.mark = np.frombuffer(raw, "<i8", n, 8), np.frombuffer(raw, "<i8", n, 8 + 8 * n)
        self.place, self.text = np.frombuffer(raw, "<i4", n, 8 + 16 * n), raw[8 + 20 * n:]
        data = np.frombuffer(self.text, np.uint8)
        self.starts, self.ends, _ = word_spans(data, np.array([0, len(data)]))
        lines = np.flatnonzero(data == 10)
        first = np.searchsorted(self.starts, np.append(-1, lines))
        counts = np.diff(np.append(first, len(self.starts))) - width + 1
        self.row = np.repeat(np.arange(n), counts)
        self.at = np.arange(len(self.row)) + np.repeat(first - np.concatenate(([0], np.cumsum(counts)[:-1])), counts)
        self.within = self.at - first[self.row]
        self.hashes = combined(span_hashes(data, self.starts, self.ends), width)[self.at]
        self.width = width

    def strings(self, chosen: np.ndarray) -> list[bytes]:
        spots = self.at[chosen]
        return [self.text[a:b] for a, b in zip(self.starts[spots].tolist(), self.ends[spots + self.width - 1].tolist(), strict=True)]


def repeats_in_bucket(bucket: list[bytes], width: int) -> Iterator[pa.RecordBatch]:
    """``doc_id, mark, place, count``: the windows of a bucket's runs that a smaller document holds too."""
    total = sum(zstandard.frame_content_size(packed) for packed in bucket)
    ranges = max(1, -(-total // RANGE_BYTES))
    for turn in range(ranges):
        found = []
        for packed in bucket:
            hashes = _Windows(packed, width).hashes
            found.append(hashes if ranges == 1 else hashes[hashes % np.uint64(ranges) == turn])
        hashes = np.sort(np.concatenate(found))
        twice = np.unique(hashes[1:][hashes[1:] == hashes[:-1]])
        del hashes, found
        if not len(twice):
            continue
        keys: dict[bytes, int] = {}
        smallest: list[int] = []
        asked = []
        for packed in bucket:
            windows = _Windows(packed, width)
            near = np.minimum(np.searchsorted(twice, windows.hashes), len(twice) - 1)
            chosen = np.flatnonzero(twice[near] == windows.hashes)
            docs = windows.doc[windows.row[chosen]]
            key = np.zeros(len(chosen), np.int64)
            for k, (text, d) in enumerate(zip(windows.strings(chosen), docs.tolist(), strict=True)):
                number = key[k] = keys.setdefault(text, len(keys))
                if number == len(smallest):
                    smallest.append(d)
                elif d < smallest[number]:
                    smallest[number] = d
            asked.append((docs, windows.mark[windows.row[chosen]], windows.place[windows.row[chosen]] + windows.within[chosen], key))
        least = np.array(smallest, np.int64)
        for docs, marks, place, key in asked:
            flagged = docs > least[key]
            docs, marks, place = docs[flagged], marks[flagged], place[flagged]
            if len(docs):
                begin = np.append(True, (docs[1:] != docs[:-1]) | (marks[1:] != marks[:-1]) | (place[1:] != place[:-1] + 1))
                first = np.flatnonzero(begin)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs[first]), pa.array(marks[first]), pa.array(place[first], pa.int32()),
                     pa.array(np.diff(np.append(first, len(docs))), pa.int32())], schema=RANGES)


def repeated_windows(docs: DataFrame, width: int = WIDTH, seed: int = SEED) -> DataFrame:
    """``doc_id, mark, place, count``: runs of windows that also start in a document of smaller ``doc_id``."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            known = batch.column("packed").is_null()
            passing = batch.filter(known)
            if passing.num_rows:
                yield passing.select(["doc_id", "mark", "place", "count"])
            batch = batch.filter(pyarrow.compute.invert(known))
            for bucket, packed in zip(batch.column("bucket").to_pylist(), batch.column("packed").to_pylist(), strict=True):
                if bucket != now and held:
                    yield from repeats_in_bucket(held, width)
                    held = []
                now = bucket
                held.append(packed)
        if held:
            yield from repeats_in_bucket(held, width)

    runs = packed_runs(docs, width, seed, buckets_for(docs, width, seed))
    return runs.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(compare, RANGE_COLUMNS)


def removed_ranges(docs: DataFrame, width: int = WIDTH, seed: int = SEED) -> DataFrame:
    """``doc_id, mark, ranges``: for each text that repeats others, the merged word ranges to remove, as 32-bit pairs."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            merged = []
            for found in batch.column("ranges"):
                flat = found.values.flatten()
                place, count = (np.asarray(c, np.int64) for c in flat)
                order = np.argsort(place, kind="stable")
                begin, end = place[order], np.maximum.accumulate((place + count + width - 1)[order])
                apart = np.append(True, begin[1:] > end[:-1])
                last = np.append(np.flatnonzero(apart)[1:] - 1, len(end) - 1)
                merged.append(np.stack([begin[apart], end[last]], axis=1).astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("mark"), pa.array(merged, pa.binary())], names=["doc_id", "mark", "ranges"])

    found = repeated_windows(docs, width, seed).groupBy("doc_id", "mark").agg(F.collect_list(F.struct("place", "count")).alias("ranges"))
    ranges = stored(found.mapInArrow(merge, "doc_id long, mark long, ranges binary"), "ranges")
    size = ranges.agg(F.sum(F.length("ranges") + 24)).first()[0] or 0
    return F.broadcast(ranges) if size <= BROADCAST_BYTES else ranges


def _cut(text: bytes, ranges: bytes | None) -> tuple[int, list[bytes]]:
    """Words of the text, and those outside the ranges."""
    words = text.split()
    n = len(words)
    if ranges:
        for begin, end in reversed(np.frombuffer(ranges, "<i4").reshape(-1, 2).tolist()):
            del words[begin:end]
    return n, words


def without_repeats(docs: DataFrame, width: int = WIDTH, seed: int = SEED) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` for every row of ``docs`` (doc_id, text).

    ``kept`` is the text without the words of windows that also start in a document of smaller ``doc_id``;
    its words are joined by one space. A text that is null, empty or shorter than a window keeps all its
    words. Windows that repeat only within one document stay, and so do those that rows of one ``doc_id``
    share: each of them is judged by its own words. A row without a ``doc_id`` comes before or after no
    other, so it loses nothing and takes nothing away. Other columns are ignored.
    """
    rows, ranges = marked(docs), removed_ranges(docs, width, seed)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = [_cut(t.as_buffer().to_pybytes(), r.as_py()) for t, r in zip(part.column("text"), part.column("ranges"), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([n for n, _ in found], pa.int64()), pa.array([n - len(w) for n, w in found], pa.int64()),
                 pa.array([b" ".join(w).decode() for _, w in found], pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])

    joined = rows.join(ranges, ["doc_id", "mark"], "left").select("doc_id", "text", "ranges")
    return joined.mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept string")


def digest(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def drop_repeats(docs: DataFrame, width: int = WIDTH, seed: int = SEED) -> DataFrame:
    """``docs`` with all its columns; texts that lose words are rewritten, ``n_chars`` follows where there is one.

    Words go as in :func:`without_repeats`. A document that loses all its words stays with an empty text; a text
    that loses none stays as it is, null too. No name of a column is taken.
    """
    names = [free_name(docs.columns, name) for name in ("own_id", "own_mark", "ranges")]
    ranges = removed_ranges(docs, width, seed).toDF(*names)
    own_id, mark, found = (ranges[name] for name in names)

    @F.pandas_udf("string")
    def cut(texts, found):
        return texts.__class__([b" ".join(_cut(t.encode(), r)[1]).decode() if r else t for t, r in zip(texts, found, strict=True)])

    text = docs["text"].cast("string")
    same = (docs["doc_id"].cast("long") == own_id) & (F.xxhash64(F.coalesce(text, F.lit(""))) == mark)
    joined = docs.join(ranges, same, "left")
    new = F.when(found.isNull(), text).otherwise(cut(text, found))
    joined = joined.select(*(new.alias(c) if c == "text" else docs[c] for c in docs.columns), found)
    if "n_chars" not in docs.columns:
        return joined.select(docs.columns)
    chars = F.when(found.isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType)
    return joined.withColumn("n_chars", chars).select(docs.columns)
