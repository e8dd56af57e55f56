"""Words of whole texts as vectors: shared by the operators that run over Arrow batches.

A word is a run of bytes other than the six ASCII white space characters (``[^\\x20\\x09-\\x0D]+``), which
never split a UTF-8 character.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vulnatlas.session import hadoop_path, shared_path

#: Bytes of text that are worked on at a time; a longer text forms a slice of its own.
SLICE_BYTES = 2_000_000

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def id_and_text(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` as long and ``text`` as string, null as empty, whatever else ``docs`` holds."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *more
    )


_scratch: list[list[str]] = []


def stored(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """``df`` written to the shared folder and read again: its lineage is cut, and any executor can read it.

    Inside :func:`scratch` it goes at the end; if it is to be kept, it does so with the block around that one, if any.
    """
    spark, path = df.sparkSession, shared_path(df.sparkSession, name)
    if len(_scratch) > keep:
        _scratch[-1 - keep].append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove what is stored inside the block, whatever becomes of it; results that read it have to be kept by then."""
    _scratch.append([])
    try:
        yield
    finally:
        for path in _scratch.pop():
            target, fs = hadoop_path(spark, path)
            fs.delete(target, True)


def free_name(taken: list[str], name: str) -> str:
    """``name``, with underscores before it until none of ``taken`` has it, in any case."""
    while name.lower() in {other.lower() for other in taken}:
        name = f"_{name}"
    return name


def remove_stored(*tables: DataFrame) -> None:
    """Remove what :func:`stored` wrote, once nothing reads it any more."""
    for table in tables:
        for folder in {file.rpartition("/")[0] for file in table.inputFiles()}:
            target, fs = hadoop_path(table.sparkSession, folder)
            fs.delete(target, True)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut between rows so that each holds about ``limit`` bytes of ``column``.

    At the end, memory that is free goes back to the system: the worker serves other stages after this one.
    """
    try:
        for batch in batches:
            if not batch.num_rows:
                continue
            ends = np.cumsum(np.asarray(pyarrow.compute.binary_length(batch.column(column)).fill_null(0), dtype=np.int64))
            first = 0
            while first < batch.num_rows:
                base = ends[first - 1] if first else 0
                last = max(first + 1, int(np.searchsorted(ends, base + limit, side="right")))
                yield batch.slice(first, last - first)
                first = last
    finally:
        give_back()


def give_back() -> None:
    """Return free memory to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def in_slices(texts: list[str], run: Callable[[list[str]], Iterable], limit: int = SLICE_BYTES // 2) -> list:
    """What ``run`` returns for each text, asked about ``limit`` characters at a time."""
    out, held, size = [], [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= limit:
            out.extend(run(held))
            held, size = [], 0
    return out + list(run(held)) if held else out


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after the other, and where each text begins, with the end at last."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and end of each word, and the number of words before each text, with the total at last."""
    solid = ~SPACE[data]
    if not len(solid):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    before = np.empty_like(solid)
    before[0], before[1:] = False, solid[:-1]
    inner = offsets[:-1]
    before[inner[inner < len(solid)]] = False
    starts = np.flatnonzero(solid & ~before)
    after = np.empty_like(solid)
    after[-1], after[:-1] = False, solid[1:]
    last = offsets[1:]
    after[last[last > 0] - 1] = False
    ends = np.flatnonzero(solid & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit values spread evenly (the finishing steps of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(kind: str, base: int, size: int) -> np.ndarray:
    if len(_powers[kind]) < size:
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        _powers[kind] = np.multiply.accumulate(steps)
    return _powers[kind]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span: a running polynomial, then :func:`mixed`."""
    n = len(data)
    up, down = _power("up", _BASE, n + 1), _power("down", _INVERSE, n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts])


def combined(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of ``width`` consecutive values; the order counts."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for k in range(1, width):
        out *= np.uint64(0xD6E8FEB86659FD93)
        out += hashes[k:k + n]
    return mixed(out)


def runs(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All of ``range(first, first + count)`` for each pair, one after the other."""
    total = int(counts.sum())
    shift = np.repeat(first - np.concatenate(([0], np.cumsum(counts)[:-1])), counts) if total else np.zeros(0, np.int64)
    return shift + np.arange(total)
