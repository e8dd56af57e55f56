"""Feed documents, each one JSON text however long, cut into small ones that hold a run of its items each.

A task that parses a document whole holds it several times over. Here the text comes in pieces, from one brace to the
next, and a scan that knows strings and nesting cuts it between two items. All that is cut is parsed by Spark as the
document would be, what stands beside the items too, so a document that is not JSON still fails.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from itertools import groupby, pairwise
from operator import itemgetter

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, DataFrameReader
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this package

ITEMS = "vulnerabilities"
#: Bytes of items after which a document is cut.
CUT_BYTES = 1 << 20
#: How cut documents are packed on their way, closer than the shuffle packs them.
PACKED = "zstd"
#: Stands between two pieces of a text. No JSON text ends with it, so none is lost at the end.
BETWEEN = b"{"
#: Strings, what opens, closes and parts values, and a quote whose string goes on after the text. Spark's parser takes both quotes.
TOKEN = re.compile(rb""""[^"\\]*+(?:\\.[^"\\]*+)*+"|'[^'\\]*+(?:\\.[^'\\]*+)*+'|[][{},"']""", re.DOTALL)
#: Half of a character, whole or cut off, which Java's decoder replaces once.
SURROGATE = re.compile(rb"\xed[\xa0-\xbf][\x80-\xbf]?")


def feed_text(reader: DataFrameReader | DataStreamReader, paths: str | list[str]) -> DataFrame:
    """The pieces of the feed documents with the part of the file that they lie in, in order within it."""
    return reader.option("lineSep", BETWEEN.decode()).text(paths).select(
        F.col("_metadata.file_modification_time").alias("landed"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        (F.col("_metadata.file_block_length") < F.col("_metadata.file_size")).alias("split"),
        F.col("value").cast("binary").alias("text"),
    )


def cut_documents(pieces: DataFrame) -> DataFrame:
    """``landed, file, n, document`` of the cut documents; ``n`` is the place of the first item in the feed.

    A compressed file is read by one task, which cuts it. Of a file that Spark splits, the splits are brought together
    in their order first. The shuffle deals out what is cut, packed, so the items are spread.
    """
    cut = pieces.mapInArrow(_cut_files, "landed timestamp, file string, start long, n long, text binary, size long")
    dealt = cut.repartition("file", F.when(F.col("start").isNull(), F.col("n"))).sortWithinPartitions("file", "start", "n")
    return dealt.mapInArrow(_cut_splits, "landed timestamp, file string, n long, document string")


def _cut_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut documents of whole files, without ``start``; the text of splits as it is, numbered."""
    for (landed, file, start, split), runs in groupby(_runs(batches), itemgetter(0)):
        texts = (text for _, text in runs)
        for n, text in enumerate(texts) if split else _cut(texts):
            yield _row(landed=landed, file=file, start=start if split else None, n=n, text=pa.compress(text, PACKED, asbytes=True), size=len(text))


def _cut_splits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut documents as they are, and those of files whose splits stand one after another."""
    rows = (row for batch in batches for row in zip(*batch.columns))
    for (landed, file, split), found in groupby(rows, lambda row: (row[0].as_py(), row[1].as_py(), row[2].is_valid)):
        texts = ((n.as_py(), pa.decompress(text.as_buffer(), size.as_py(), PACKED, asbytes=True)) for *_, n, text, size in found)
        for n, text in _cut(text for _, text in texts) if split else texts:
            yield _row(landed=landed, file=file, n=n, document=SURROGATE.sub(b"\xef\xbf\xbd", text).decode("utf-8", "replace"))


def _row(**values) -> pa.RecordBatch:
    types = {"landed": pa.timestamp("us", "UTC"), "file": pa.string(), "start": pa.int64(), "n": pa.int64(), "text": pa.binary(), "size": pa.int64(), "document": pa.string()}
    return pa.RecordBatch.from_arrays([pa.array([v], types[k]) for k, v in values.items()], list(values))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, bytes]]:
    """The values of each batch's neighbouring rows of one part of a file, and their pieces joined."""
    for batch in batches:
        changed = set()
        for column in batch.columns[:-1]:
            code = column.dictionary_encode().indices.to_numpy()
            changed.update((code[1:] != code[:-1]).nonzero()[0] + 1)
        for first, end in pairwise(sorted({0, *changed, batch.num_rows})):
            text = BETWEEN.join(batch.columns[-1][first:end].to_pylist())
            yield tuple(column[first].as_py() for column in batch.columns[:-1]), text


def _cut(texts: Iterator[bytes]) -> Iterator[tuple[int, bytes]]:
    """Cut documents of one document's text with the places of their first items."""
    cutter = Cutter()
    for k, text in enumerate(texts):
        yield from cutter.cut(BETWEEN + text if k else text)
    yield from cutter.last()


class Cutter:
    """Cuts the text of one document as it comes."""

    def __init__(self) -> None:
        self.text, self.at = b"", 0  # what is not given out yet, and how far it is scanned
        self.enough = 0  # bytes up to which more text is waited for, as a string goes on
        self.depth, self.inside = 0, False  # nesting, and whether the list of items is open
        self.named, self.name = True, b""  # whether a name comes next in the outermost object, and the last one
        self.found = False  # whether the name of the items was read
        self.items = self.first = 0  # places of the item being read, and of the first one not given out
        self.beside: list[bytes] = []  # the document without its items
        self.whole = self.over = False

    def cut(self, text: bytes) -> Iterator[tuple[int, bytes]]:
        if self.over:
            return
        self.text += text
        if self.whole or len(self.text) < self.enough:
            return
        text, depth, begin = self.text, self.depth, 0
        self.at, at = len(text), self.at
        for token in TOKEN.finditer(text, at):
            here = token.start()
            kind = text[here]
            if kind == 0x2C:  # ,
                if depth == 1:
                    self.named = True
                elif depth == 2 and self.inside:
                    self.items += 1
                    if here - begin >= CUT_BYTES:
                        yield self._items(text[begin:here], self.items)
                        begin = here + 1
            elif kind in b"{[":
                if not depth and kind == 0x5B:  # [
                    self.whole = True  # documents in a list, which Spark takes as well
                    break
                depth += 1
                if depth == 2 and kind == 0x5B and self.name == ITEMS.encode():
                    self.inside, self.items, self.first = True, 0, 0
                    self.beside.append(text[begin:here + 1])
                    begin = here + 1
            elif kind in b"}]":
                depth -= 1
                if depth == 1 and self.inside:
                    self.inside = False
                    if self.first or text[begin:here].strip():
                        yield self._items(text[begin:here], 0)
                    begin = here
                elif depth <= 0:
                    self.over = True  # Spark does not look at what follows either
                    self.beside.append(text[begin:here + 1])
                    break
            elif token.end() == here + 1:
                self.at, self.enough = here, 2 * len(text) - here - begin
                break
            elif depth == 0:
                self.whole = True
                break
            elif depth == 1 and self.named:
                self.named, self.name = False, _plain(token[0])
                if self.name == ITEMS.encode():
                    if self.found:
                        raise ValueError(f"a feed document names {ITEMS} twice")
                    self.found = True
        self.text, self.at, self.depth = text[begin:], self.at - begin, depth

    def last(self) -> Iterator[tuple[int, bytes]]:
        """The document without its items; what it lacks at its end Spark's parser finds out."""
        if self.inside:
            yield self.first, b"".join(self.beside) + self.text
        elif self.over or self.beside or self.text.strip():
            yield 0, b"".join(self.beside) + (b"" if self.over else self.text)
        elif not self.text:
            yield 0, BETWEEN

    def _items(self, items: bytes, following: int) -> tuple[int, bytes]:
        first, self.first = self.first, following
        return first, b'{"%s":[%s]}' % (ITEMS.encode(), items if items.strip() else b",")


def _plain(name: bytes) -> bytes:
    """A name without quotes and escapes."""
    return re.sub(rb"\\u([0-9a-fA-F]{4})", lambda m: chr(int(m[1], 16)).encode("utf-8", "replace"), name[1:-1])
