"""Token ids of whole texts in binary files: 64-bit words of packed ids (Simple-8b) with offsets per block.

A file holds blocks of ``BLOCK`` ids, one document's ids after another's in ascending ``doc_id``:

    magic "SB8\\0" | number of blocks, of ids, of documents (uint64)
    per block: number of its first word (uint64)
    words (uint64): selector in the 4 highest bits, then ids of one width, the first in the lowest bits
    per document: doc_id (int64), number of ids (uint64)

A selector s packs ``COUNTS[s]`` ids of ``60 // COUNTS[s]`` bits; the last word of a block may hold fewer. The
last selector is the escape: the next word as a whole is one id, so any 64-bit value can be stored. Blocks
stand alone, so all of them are encoded and decoded side by side, one selector at a time over whole vectors.

Documents are dealt to tasks by ranges of ``doc_id``; each task tokenises and writes one file per
``FILE_IDS`` ids, under a name of its own that it takes when the file is whole: a task that runs again
writes the same file again. Only the counts per file meet on the way to the offsets.
"""

from __future__ import annotations

import codecs
import json
import unicodedata
import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import cached_property
from itertools import pairwise

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vulnatlas.llm.text import SPACE, id_and_text, slices, stored
from vulnatlas.session import hadoop_path, shared_path

BLOCK = 1024
FILE_IDS = 4_000_000
#: Files whose starts are broadcast to their contents; beyond, both sides are shuffled.
BROADCAST_FILES = 1_000_000
#: Ids that are packed at a time: whole blocks.
PACKED_IDS = 512 * BLOCK
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = 60 // COUNTS
ESCAPE = len(COUNTS)
MAGIC = b"SB8\0"
END_ID = 2
#: Words, and parts of words, whose ids a worker keeps for the next texts, and their bytes with those of the ids.
KEPT_WORDS = 400_000
KEPT_BYTES = 64_000_000
#: Parts that go to the merges at a time, and bytes of text that are encoded at a time.
MERGED_PARTS = 4_000
ENCODED_BYTES = 4_000_000

# How the tokenizer of lower-cased words normalises and cuts, as its file has it.
END = "</w>"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": PATTERN}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
CUT = regex.compile(PATTERN.replace(r"\s", r"\p{White_Space}"))
# The same for Latin-1 texts, a byte a character: lower case, and what each character is to the pattern.
LOWERED = bytes(ord(chr(k).lower()) for k in range(256))
LETTER, DIGIT, OTHER = 1, 2, 3
KINDS = bytes(
    0 if regex.match(r"\p{White_Space}", chr(k)) else LETTER if regex.match(r"\p{L}", chr(k)) else DIGIT if regex.match(r"\p{N}", chr(k)) else OTHER
    for k in range(256))
#: What goes with the apostrophe before it: its first two bytes, by the size of both.
SHORT = {2: [ord(c) << 8 for c in "stmd"], 3: [ord(a) << 8 | ord(b) for a, b in ("re", "ve", "ll")]}
#: Words of characters below this one are normalised here; above, other versions of Unicode may differ.
LATIN = "\u0250"


def _byte_characters() -> list[str]:
    """The character that stands for each byte in the tokenizer's vocabulary: itself if printable, else from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b if b in shown else next(rest)) for b in range(256)]


BYTES = _byte_characters()
#: The same as a table for whole lists of words, which keep the space between them.
SPACED_BYTES = "".join([*BYTES[:32], " ", *BYTES[33:]])


def default_tokenizer() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(words, first word of each block)`` of 64-bit ids; each word takes as many ids as its widest allows."""
    ids = np.ascontiguousarray(ids, np.uint64)
    n = len(ids)
    blocks = -(-n // BLOCK)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    # The narrowest width that holds each id, by number; a block's end is followed by narrow ones.
    need = np.zeros(blocks * BLOCK, np.uint8)
    for width in WIDTHS:
        need[:n] += ids >= np.uint64(1 << int(width))
    need = np.hstack([need.reshape(blocks, BLOCK), np.zeros((blocks, COUNTS[0]), np.uint8)])
    choice = np.full((blocks, BLOCK), ESCAPE, np.int8)
    most, have = need, 1  # the widest of the next ``have`` ids
    for s in range(len(COUNTS) - 1, -1, -1):
        while have < COUNTS[s]:
            step = min(have, COUNTS[s] - have)
            most = np.maximum(most[:, :-step], most[:, step:])
            have += step
        choice[most[:, :BLOCK] <= s] = s
    choice = choice.ravel()[:n]
    takes = np.append(COUNTS, 1)[choice]
    # From block to block side by side: where each word begins.
    at = np.arange(blocks) * BLOCK
    stop = np.minimum(at + BLOCK, n)
    begun = np.zeros(n, bool)
    while len(at):
        begun[at] = True
        at = at + takes[at]
        go = at < stop
        at, stop = at[go], stop[go]
    first = np.flatnonzero(begun)
    kind = choice[first]
    spot = np.arange(len(first)) + np.concatenate(([0], np.cumsum(kind == ESCAPE)[:-1]))
    words = np.zeros(len(first) + int((kind == ESCAPE).sum()), np.uint64)
    words[spot] = kind.astype(np.uint64) << np.uint64(60)
    last = np.append(first[1:], n)
    for s in range(len(COUNTS)):
        chosen = np.flatnonzero(kind == s)
        for k in range(COUNTS[s]):
            have = chosen[first[chosen] + k < last[chosen]]
            words[spot[have]] |= ids[first[have] + k] << np.uint64(k * WIDTHS[s])
    escaped = np.flatnonzero(kind == ESCAPE)
    words[spot[escaped] + 1] = ids[first[escaped]]
    return words, spot[np.searchsorted(first, np.arange(blocks) * BLOCK)].astype(np.uint64)


def unpack(words: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ids of :func:`pack`: blocks side by side, one word of each at a time."""
    out = np.zeros(n, np.uint64)
    at = offsets.astype(np.int64)
    place = np.arange(len(offsets)) * BLOCK
    stop = np.minimum(place + BLOCK, n)
    takes = np.append(COUNTS, 1)
    while len(at):
        word = words[at]
        kind = (word >> np.uint64(60)).astype(np.int64)
        for s in np.unique(kind):
            chosen = np.flatnonzero(kind == s)
            if s == ESCAPE:
                out[place[chosen]] = words[at[chosen] + 1]
                continue
            mask = np.uint64((1 << int(WIDTHS[s])) - 1)
            spots = place[chosen][:, None] + np.arange(COUNTS[s])
            values = (word[chosen][:, None] >> (np.arange(COUNTS[s], dtype=np.uint64) * np.uint64(WIDTHS[s]))) & mask
            inside = spots < stop[chosen][:, None]
            out[spots[inside]] = values[inside]
        place = place + takes[kind]
        at = at + 1 + (kind == ESCAPE)
        go = place < stop
        at, place, stop = at[go], place[go], stop[go]
    return out


def file_bytes(doc_ids: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> bytes:
    parts, offsets, base = [], [], 0
    for a in range(0, len(ids), PACKED_IDS):
        words, first = pack(ids[a:a + PACKED_IDS])
        parts.append(words)
        offsets.append(first + np.uint64(base))
        base += len(words)
    words, offsets = (np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (parts, offsets))
    head = np.array([len(offsets), len(ids), len(doc_ids)], "<u8")
    return b"".join((
        MAGIC, head.tobytes(), offsets.astype("<u8").tobytes(), words.astype("<u8").tobytes(),
        doc_ids.astype("<i8").tobytes(), counts.astype("<u8").tobytes()))


def read_file(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(doc_ids, counts, ids)`` of a file."""
    if data[:4] != MAGIC:
        raise ValueError("not a file of packed token ids")
    blocks, n, docs = np.frombuffer(data, "<u8", 3, 4).tolist()
    offsets = np.frombuffer(data, "<u8", blocks, 28)
    tail = len(data) - 16 * docs
    words = np.frombuffer(data, "<u8", (tail - 28) // 8 - blocks, 28 + 8 * blocks)
    return np.frombuffer(data, "<i8", docs, tail), np.frombuffer(data, "<u8", docs, tail + 8 * docs), unpack(words, offsets, n)


class WordTokens:
    """Ids of whole texts by the tokenizers library, found once for each word.

    The tokenizer drops white space and never looks across it, so a text's ids are those of its words, one
    after the other. Texts, or else words, of Latin letters are normalised and cut as the tokenizer does it, and
    their parts go to its merges many at a time: a part's last id is the only one that ends a word. All others go
    to the tokenizer as they are. A tokenizer of another kind gets every word as it is. Arrow numbers the distinct
    words of a slice of texts and puts their ids in place of each, so only distinct ones are looked up one by one.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, decoders, models, normalizers, pre_tokenizers

        self.path, merges = path, Tokenizer.from_file(path)
        self.known_parts, self.known_words = Known(), Known()
        self.parts: dict[str, bytes] = {}
        self.parts_bytes = 0
        rules = Tokenizer(models.BPE())  # with the rules alone: the vocabulary is long to write and read
        rules.normalizer, rules.pre_tokenizer = merges.normalizer, merges.pre_tokenizer
        rules = json.loads(rules.to_str())
        ends = getattr(merges.model, "end_of_word_suffix", None) == END
        self.plain = rules["normalizer"] == NORMALIZER and rules["pre_tokenizer"] == PRE_TOKENIZER and ends
        if self.plain:
            merges.normalizer, merges.pre_tokenizer, merges.decoder = normalizers.Sequence([]), pre_tokenizers.WhitespaceSplit(), decoders.Fuse()
            self.merges = merges
            vocabulary = merges.get_vocab()
            self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends[[k for name, k in vocabulary.items() if name.endswith(END)]] = True

    @cached_property
    def tokenizer(self):
        """The tokenizer itself: only texts that are not normalised here need it."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _merge(self, runs: Iterable[str]) -> pa.Array:
        """The ids of parts that are one run for the merges each; many are given at a time, with a space between them."""
        ids, ends, size = [], [np.zeros(1, np.int64)], 0
        for run in runs:
            mapped = codecs.charmap_decode(run.encode(), "strict", SPACED_BYTES)[0]
            ids.append(np.array(self.merges.encode_batch_fast([mapped], add_special_tokens=False)[0].ids, "<u4"))
            cuts = np.flatnonzero(self.ends[ids[-1]]) + 1
            if len(cuts) != run.count(" ") + 1:
                raise ValueError("the merges do not end each part with one id")
            ends.append(size + 4 * cuts)
            size = int(ends[-1][-1])
        return byte_strings(np.concatenate([np.zeros(0, "<u4"), *ids]), np.concatenate(ends))

    def _learn_parts(self, parts: pa.Array) -> pa.Array:
        """The ids of parts of Latin-1 texts."""
        return self._merge(b" ".join(parts[a:a + MERGED_PARTS].to_pylist()).decode("latin-1") for a in range(0, len(parts), MERGED_PARTS))

    def _learn_words(self, words: pa.Array) -> pa.Array:
        """The ids of words of any characters."""
        cut, rest, texts = {}, [], [w.decode() for w in words.to_pylist()]
        for text in texts:
            if self.plain and (text.isascii() or max(text) < LATIN) and "<|" not in text:
                cut[text] = CUT.findall((text if text.isascii() else unicodedata.normalize("NFC", text)).lower())
            else:
                rest.append(text)
        fresh = sorted({p for parts in cut.values() for p in parts if p not in self.parts})
        found = self._merge(" ".join(fresh[a:a + MERGED_PARTS]) for a in range(0, len(fresh), MERGED_PARTS))
        self.parts.update(zip(fresh, found.to_pylist(), strict=True))
        self.parts_bytes += sum(map(len, fresh)) + found.nbytes
        ids = {text: b"".join(map(self.parts.__getitem__, parts)) for text, parts in cut.items()} | dict(zip(rest, self._ids(rest), strict=True))
        return pa.array([ids[t] for t in texts], pa.large_binary())

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit integers."""
        self.known_parts.thin()
        self.known_words.thin()
        if len(self.parts) > KEPT_WORDS or self.parts_bytes > KEPT_BYTES:
            self.parts.clear()
            self.parts_bytes = 0
        simple = [self._simple(t) for t in texts]
        whole = iter(self._by_parts([t for t in simple if t is not None]))
        words = iter(self._by_words([t for t, s in zip(texts, simple, strict=True) if s is None]))
        return [next(words if s is None else whole) for s in simple]

    def _simple(self, text: bytes) -> bytes | None:
        """A text that is cut here as a whole, a byte a character: of the first 256, which normalising leaves as they are."""
        if not self.plain or b"<|" in text:
            return None
        try:
            return text if text.isascii() else text.decode().encode("latin-1")
        except UnicodeEncodeError:
            return None

    def _by_parts(self, texts: list[bytes]) -> list[bytes]:
        """The ids of texts as :meth:`_simple` gives them."""
        lowered = b" ".join([*texts, b" "]).translate(LOWERED)  # two bytes of white space at the end
        return self.known_parts.placed(lowered, *cut_parts(lowered), texts, self._learn_parts) if texts else []

    def _by_words(self, texts: list[bytes]) -> list[bytes]:
        """The ids of other texts."""
        joined = b" ".join([*texts, b""])
        solid = ~SPACE[np.frombuffer(joined, np.uint8)]
        begun = solid.copy()
        begun[1:] &= ~solid[:-1]
        return self.known_words.placed(joined, solid, begun, texts, self._learn_words) if texts else []


class Known:
    """Words that were met, the ids of each, and in how many slices of texts it was."""

    def __init__(self):
        self.words, self.ids, self.met = pa.array([], pa.large_binary()), pa.array([], pa.large_binary()), np.zeros(0, np.int64)

    def thin(self) -> None:
        """Of too many words, or bytes, forget all but half of what may be kept: the words that were met most."""
        if len(self.words) > KEPT_WORDS or self.words.nbytes + self.ids.nbytes > KEPT_BYTES:
            most = np.argsort(-self.met, kind="stable")[:KEPT_WORDS // 2]
            sizes = pc.add(pc.binary_length(self.words), pc.binary_length(self.ids)).to_numpy()[most] + 16  # and an offset each
            most = most[np.cumsum(sizes) <= KEPT_BYTES // 2]
            self.words, self.ids, self.met = self.words.take(pa.array(most)), self.ids.take(pa.array(most)), self.met[most] // 2

    def placed(self, joined: bytes, solid: np.ndarray, begun: np.ndarray, texts: list[bytes], learn: Callable[[pa.Array], pa.Array]) -> list[bytes]:
        """The ids of each text, for each of its words those that are known or else ``learn`` finds.

        ``joined`` holds the texts, a space behind each; ``solid`` says which bytes are in words, ``begun`` which begin one.
        """
        data = np.frombuffer(joined, np.uint8)[solid]
        words = byte_strings(data, np.append(np.flatnonzero(begun[solid]), len(data))).dictionary_encode()
        numbers = pc.index_in(words.dictionary, value_set=self.words)
        if numbers.null_count:
            new, n = numbers.is_null(), len(self.words)
            fresh = words.dictionary.filter(new)
            numbers = pc.replace_with_mask(numbers, new, pa.array(np.arange(n, n + len(fresh), dtype=np.int32)))
            self.words, self.ids, self.met = (
                pa.concat_arrays([self.words, fresh]), pa.concat_arrays([self.ids, learn(fresh)]), np.append(self.met, np.zeros(len(fresh), np.int64)))
        self.met[numbers.to_numpy(zero_copy_only=False)] += 1
        ids = self.ids.take(numbers.take(words.indices))
        begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
        counts = np.add.reduceat(begun, begins[:-1], dtype=np.int64)
        places = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1, 8 * ids.offset)
        ends = places[np.cumsum([0, *counts])].tolist()
        raw = memoryview(ids.buffers()[2] or b"")
        return [raw[first:last].tobytes() for first, last in pairwise(ends)]


def byte_strings(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Strings of bytes one after the other in ``data``, the first from ``ends[0]`` on."""
    return pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(data)])


def cut_parts(lowered: bytes) -> tuple[np.ndarray, np.ndarray]:
    """For lower-cased Latin-1 text: whether each character is in a part of ``PATTERN``, and whether it begins one.

    The text has to end with two characters of white space.
    """
    kind = np.frombuffer(lowered.translate(KINDS), np.uint8)
    solid = kind != 0
    begun = np.empty(len(kind), bool)
    begun[0] = True
    np.not_equal(kind[1:], kind[:-1], out=begun[1:])
    begun |= kind == DIGIT
    begun &= solid
    # An apostrophe that begins a run, before certain letters: they go with it, and the next letters begin anew.
    data = np.frombuffer(lowered, np.uint8)
    quotes = np.flatnonzero((data == ord("'")) & begun)
    quotes = quotes[kind[quotes + 1] == LETTER]
    after = data[quotes + 1].astype(np.uint16) << 8
    for size, endings in SHORT.items():
        pairs = after | (data[quotes + 2] if size == 3 else 0)
        chosen = quotes[np.isin(pairs, endings)]
        begun[chosen + 1] = False
        begun[chosen + size] |= kind[chosen + size] == LETTER
    return solid, begun


def open_folder(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system and inner path of a folder that all executors share; names of schemes as Spark has them."""
    scheme, colon, inner = path.partition(":")
    if scheme == "dbfs":  # mounted at every executor
        return pyarrow.fs.LocalFileSystem(), "/dbfs/" + inner.lstrip("/")
    if scheme == "file" or not colon or "://" not in path:
        return pyarrow.fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return pyarrow.fs.FileSystem.from_uri({"s3a": "s3", "s3n": "s3", "gs": "gs"}.get(scheme, scheme) + ":" + inner)


def write_whole(folder: str, name: str, data: bytes) -> None:
    """A file that appears under its name only when it is whole; the same name replaces what a first attempt left."""
    fs, inner = open_folder(folder)
    fs.create_dir(inner, recursive=True)
    draft = f"{inner}/.{name}-{TaskContext.get().taskAttemptId()}"
    with fs.open_output_stream(draft) as out:
        out.write(data)
    fs.move(draft, f"{inner}/{name}")


def write_tokens(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Write the ids of ``docs`` (doc_id, text), each followed by ``end_id``; ``file, number, ids`` of each file.

    ``number`` orders the files. Documents are ordered by ``doc_id``, rows without one first, rows that repeat
    it by their text. A text that is null or empty is its end id alone. Other columns are ignored.
    """
    tokenizer = tokenizer or default_tokenizer()
    # A worker has one copy of what is broadcast for all its tasks: there it keeps the tokenizer and the words it met.
    shared = docs.sparkSession.sparkContext.broadcast({})

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part = shared.value.get("words") or shared.value.setdefault("words", WordTokens(tokenizer)), TaskContext.get().partitionId()
        end = np.array([end_id], "<u4").tobytes()
        ids, counts, doc_ids, size, turn = [], [], [], 0, 0

        def flush() -> pa.RecordBatch:
            name = f"part-{part:06d}-{turn:06d}.ids"
            write_whole(folder, name, file_bytes(np.array(doc_ids, np.int64), np.array(counts, np.uint64), np.frombuffer(b"".join(ids), "<u4")))
            return pa.RecordBatch.from_pydict({"file": [name], "number": pa.array([part * 1_000_000 + turn], pa.int64()), "ids": pa.array([size], pa.int64())})

        for batch in slices(batches, limit=ENCODED_BYTES):
            rows = words.encode([t.as_buffer().to_pybytes() for t in batch.column("text")])
            for doc_id, row in zip(batch.column("doc_id").fill_null(NO_ID).to_pylist(), rows, strict=True):
                ids.append(row + end)
                counts.append(len(row) // 4 + 1)
                doc_ids.append(doc_id)
                size += counts[-1]
                if size >= FILE_IDS:
                    yield flush()
                    ids, counts, doc_ids, size, turn = [], [], [], 0, turn + 1
        if doc_ids:
            yield flush()

    rows = id_and_text(docs).repartitionByRange(F.col("doc_id").asc_nulls_first())
    rows = rows.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    return rows.mapInArrow(write, "file string, number long, ids long")


NO_ID = -(1 << 63)


def read_tokens(files: DataFrame, folder: str, with_ids: bool = True) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32, ids`` of each document, from the files that :func:`write_tokens` returned.

    ``start`` counts the ids of all documents before it; ``ids_crc32`` is of its ids as little-endian unsigned
    32-bit integers. Files of an attempt that was not reported are not read.
    """
    spark = files.sparkSession
    # One row for each file of millions of ids: the running sum over them is small, and so is what is broadcast.
    starts = files.select("file", F.coalesce(F.sum("ids").over(Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, base in zip(batch.column("content"), batch.column("base").to_pylist(), strict=True):
                doc_ids, counts, ids = read_file(data.as_buffer().to_pybytes())
                ends = np.cumsum(counts.astype(np.int64))
                ids = ids.astype("<u4")
                for a in range(0, len(doc_ids), 1000):
                    some = slice(a, a + 1000)
                    first = int(ends[a] - counts[a])
                    marks = [zlib.crc32(ids[e - c:e].tobytes()) for e, c in zip(ends[some].tolist(), counts[some].astype(np.int64).tolist(), strict=True)]
                    known = doc_ids[some]
                    out = {
                        "doc_id": pa.array(known, mask=known == NO_ID),
                        "start": pa.array(base + ends[some] - counts[some].astype(np.int64)),
                        "n_tokens": pa.array(counts[some].astype(np.int64)), "ids_crc32": pa.array(marks, pa.int64()),
                    }
                    if with_ids:
                        cuts = np.concatenate(([0], ends[some] - first)).astype(np.int32)
                        out["ids"] = pa.ListArray.from_arrays(pa.array(cuts), pa.array(ids[first:int(ends[some][-1])].astype(np.int64)))
                    yield pa.RecordBatch.from_pydict(out)

    content = spark.read.format("binaryFile").option("pathGlobFilter", "*.ids").load(folder)
    content = content.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    starts = F.broadcast(starts) if files.count() <= BROADCAST_FILES else starts
    return content.join(starts, "file").select("content", "base").mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids)


def round_trip(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of the documents as read back from their files."""
    target, fs = hadoop_path(docs.sparkSession, shared_path(docs.sparkSession, "tokens"))
    fs.mkdirs(target)
    folder = fs.makeQualified(target).toString()
    files = stored(write_tokens(docs, folder, tokenizer), "token-files")
    return read_tokens(files, folder, with_ids=False)
