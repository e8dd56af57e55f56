"""Periodic runs: stretches of words that repeat four times or more, caught online by dyadic blocks.

Words are appended to a stream. On level k the stream is cut into blocks of ``2**k`` words; each completed block
has a catcher, which waits for its copy at a distance ``q`` from ``2**k`` to ``2**(k + 1) - 1``: the second half of
a square whose first half begins in the block. An appended word completes one block comparison per catcher that
still waits, so a level costs a comparison a word, and all levels together ``log n``. A run of period ``q`` and
at least ``4 * q`` words holds two blocks next to each other that are both caught at distance ``q``; such squares
are widened to both sides and merge into runs. Runs that reach the end of the stream stay open and grow with the
next words. What lies within a run of a smaller period is that run again and goes no further.

Words arrive in pieces, and the comparisons of a piece are made a level at a time as vectors of block hashes;
every run found is confirmed on the words themselves. Texts follow each other in a stream, parted by marks that
equal no word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vulnatlas.llm.text import id_and_text, mixed, slices

#: Words appended at a time.
PIECE = 1 << 18
#: A run has this many words at least, and this many times its period.
LEAST, TIMES = 6, 4

RUNS = "array<struct<start: long, length: long, period: long>>"


class Catchers:
    """The catchers of one stream of word hashes."""

    def __init__(self, levels: int):
        self.levels = levels
        self.hashes = [np.zeros(0, np.uint64) for _ in range(levels)]  # of each 2**k words from each place
        self.words = np.zeros(0, np.uint64)
        self.runs: dict[tuple[int, int], int] = {}  # (start, end) -> smallest period
        self.open: dict[tuple[int, int], int] = {}  # (start, period) -> end, of stretches that reach the end

    def append(self, words: np.ndarray) -> None:
        """Advance all catchers by these words."""
        before = len(self.words)
        self.words = np.concatenate([self.words, words])
        for (start, period), end in list(self.open.items()):
            self._keep(period, start, self._rightwards(period, end))
        for level in range(self.levels):
            self._grow(level)
            self._catch(level, before)

    def found(self) -> list[tuple[int, int, int]]:
        """``(start, end, period)`` of the runs among the words so far, by start and period."""
        for (start, period), end in self.open.items():
            self._note(period, start, end)
        return sorted((start, end, period) for (start, end), period in self.runs.items())

    def _grow(self, level: int) -> None:
        if not level:
            self.hashes[0] = self.words
            return
        half, known = 1 << (level - 1), len(self.hashes[level])
        parts = self.hashes[level - 1]
        if len(parts) - half > known:
            fresh = mixed(parts[known:len(parts) - half] * np.uint64(0xD6E8FEB86659FD93) + parts[known + half:])
            self.hashes[level] = np.concatenate([self.hashes[level], fresh])

    def _catch(self, level: int, before: int) -> None:
        """Compare the blocks whose catchers meet a word appended after the first ``before``."""
        size, hashes = 1 << level, self.hashes[level]
        first = max(0, (before - 3 * size + 1) // size - 1)  # the last block that had met all its words, for pairs
        last = (len(self.words) - 2 * size) // size
        if last < first:
            return
        ahead = hashes[(first + 1) * size:(last + 2) * size]
        there = len(ahead)
        ahead = np.concatenate([ahead, np.zeros((last + 1 - first) * size - there, np.uint64)]).reshape(-1, size)
        caught = hashes[first * size:last * size + 1:size, None] == ahead
        caught.reshape(-1)[there:] = False
        blocks, places = np.nonzero(caught[:-1] & caught[1:])
        if not len(blocks):
            return
        starts, periods = (blocks + first) * size, places + size
        alone = ~self._covered(size, starts, starts + periods + 2 * size)
        starts, periods = starts[alone], periods[alone]
        order = np.lexsort((starts, periods))
        starts, periods = starts[order], periods[order]
        heads = np.flatnonzero(np.concatenate(([True], (np.diff(periods) != 0) | (np.diff(starts) > size)))) if len(starts) else []
        for n, head in enumerate(heads):
            tail = (heads[n + 1] if n + 1 < len(heads) else len(starts)) - 1
            period = int(periods[head])
            start = self._leftwards(period, int(starts[head]))
            self._keep(period, start, self._rightwards(period, int(starts[tail]) + 2 * size + period))

    def _covered(self, size: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Whether a known stretch of a period of at most ``size`` holds the words from each start to its end.

        Two blocks of such a size at a larger distance are then that stretch again, at a multiple of its period.
        """
        known = [span for span, period in self.runs.items() if period <= size]
        known += [(start, end) for (start, period), end in self.open.items() if period <= size]
        known = np.array(sorted(known), np.int64).reshape(-1, 2)
        if not len(known):
            return np.zeros(len(starts), bool)
        reach = np.concatenate(([-1], np.maximum.accumulate(known[:, 1])))
        return reach[np.searchsorted(known[:, 0], starts, side="right")] >= ends

    def _leftwards(self, period: int, start: int) -> int:
        """Where the stretch of ``period`` that holds ``start`` begins."""
        step = 64
        while start:
            low = max(0, start - step)
            differs = np.flatnonzero(self.words[low:start] != self.words[low + period:start + period])
            if len(differs):
                return low + int(differs[-1]) + 1
            start, step = low, 2 * step
        return 0

    def _rightwards(self, period: int, end: int) -> int:
        """Where the stretch of ``period`` that reaches ``end`` ends."""
        step = 64
        while end < len(self.words):
            high = min(len(self.words), end + step)
            differs = np.flatnonzero(self.words[end:high] != self.words[end - period:high - period])
            if len(differs):
                return end + int(differs[0])
            end, step = high, 2 * step
        return end

    def _keep(self, period: int, start: int, end: int) -> None:
        self.open.pop((start, period), None)
        if end == len(self.words):
            self.open[start, period] = end
        else:
            self._note(period, start, end)

    def _note(self, period: int, start: int, end: int) -> None:
        if end - start >= max(LEAST, TIMES * period):
            self.runs[start, end] = min(period, self.runs.get((start, end), period))


def text_runs(texts: list[list[bytes]], piece: int = PIECE) -> list[list[tuple[int, int, int]]]:
    """``(start, length, period)`` of the runs of each list of words, by start and period.

    Texts with the same number of levels share a stream.
    """
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    streams: dict[int, list[int]] = {}
    for n, words in enumerate(texts):
        if len(words) >= LEAST:
            streams.setdefault((len(words) // TIMES).bit_length(), []).append(n)
    for levels, members in streams.items():
        catchers, begins, at = Catchers(levels), [], 0
        held: list[np.ndarray] = []
        for place, n in enumerate(members):
            begins.append(at)
            # Marks are odd, words even: no mark equals a word, or another mark.
            held += [np.fromiter(map(hash, texts[n]), np.int64, len(texts[n])).view(np.uint64) << np.uint64(1), np.array([2 * place + 1], np.uint64)]
            at += len(texts[n]) + 1
        stream = np.concatenate(held)
        for first in range(0, len(stream), piece):
            catchers.append(stream[first:first + piece])
        for start, end, period in catchers.found():
            place = int(np.searchsorted(begins, start, side="right")) - 1
            words, low = texts[members[place]], start - begins[place]
            if words[low:low + end - start - period] == words[low + period:low + end - start]:
                out[members[place]].append((low, end - start, period))
    return [sorted(found, key=lambda run: (run[0], run[2])) for found in out]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one space, without those that a run holds after its first period."""
    if not runs:
        return b" ".join(words)
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period:start + length] = False
    return b" ".join([words[n] for n in np.flatnonzero(kept)])


def periodic_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, runs, text`` for every row of ``docs`` (doc_id, text): its runs and the text without their repeats.

    A run is a stretch of words with smallest period q and at least ``max(6, 4 * q)`` words that no word beside it
    continues; ``runs`` lists ``start, length, period`` by start and period, start counting words from 0. ``text``
    has its words joined by one space, those left out that a run holds after its first q words. Null, empty and
    white texts have no words and no runs. A row counts by itself: repeated rows and rows without an id get a row
    each. A text is worked on whole, in memory in proportion to its words. Other columns are ignored.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = [text.encode().split() for text in part.column("text").to_pylist()]
            found = text_runs(texts)
            runs = [[{"start": s, "length": n, "period": q} for s, n, q in runs] for runs in found]
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), pa.array(map(len, texts), pa.int64()),
                pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
                pa.array([collapsed(words, runs).decode() for words, runs in zip(texts, found, strict=True)], pa.string()),
            ], names=["doc_id", "n_words", "runs", "text"])

    return id_and_text(docs).mapInArrow(find, f"doc_id long, n_words long, runs {RUNS}, text string")


def with_loops(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with the words of every tenth document repeated from some place on, as the query's contract has it.

    With ``h = crc32(doc_id)``, documents of ``h % 10 = 0`` have word ``a + (i - a) % p`` at each place ``i >= a``.
    """
    g = F.floor(F.crc32(F.col("doc_id").cast("string")) / 10)

    def looped(words: Column) -> Column:
        n = F.size(words)
        a = (g % n).cast("int")
        p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
        places = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.when(i < a, i).otherwise(a + (i - a) % p))
        return F.when(n > 0, F.array_join(F.transform(places, lambda i: F.get(words, i)), " ")).otherwise("")

    # The words are the variable of an outer transform: inside it, they are cut once.
    words = F.array(F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1)))
    loops = F.crc32(F.col("doc_id").cast("string")) % 10 == 0
    return id_and_text(docs).select("doc_id", F.when(loops, F.get(F.transform(words, looped), 0)).otherwise(F.col("text")).alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """The longest run of each document, and digests of its runs and of its collapsed text."""
    longest = F.array_min(F.transform("runs", lambda r: F.struct(-r["length"], r["start"], r["period"])))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.withColumn("longest", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("longest.start").alias("start"),
        (-F.col("longest.col1")).alias("length"), F.col("longest.period").alias("period"),
        F.floor(-F.col("longest.col1") * 1000 / F.col("longest.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("collapsed_sha256"),
    )
