"""Sampled SentencePiece segmentations, reproducible by row, and lossless decoding.

Every way to cut a text into pieces is a path through the piece lattice. A piece weighs
``exp(ALPHA * log-weight)``, its log-weight following Zipf's law of its rank in the vocabulary; a character that
no piece holds is written as its UTF-8 bytes, at ``BYTE`` each. Forward filtering sums the weights of all
paths to each place, backward sampling draws the last piece, then the one before it, and so on, each with its
exact probability. The draws come from a counter: row key, place in the text and seed, so the result depends
neither on partitioning nor on retries.

Pieces never cross from one word to the next (a word takes the white space mark before it), so the lattice
falls into words: forward values are found once for each distinct word of a slice, for all words of a length at
a time, and only the draws are made for each occurrence.

A piece file without weights of its own (a merge list) is meant here; its literal mark character is written as
bytes, so that decoding gives back every text exactly.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute
import sentencepiece
from pyspark.sql import DataFrame

from vulnatlas.llm.text import id_and_text, mixed, runs, slices

ALPHA = 1.0
BYTE = -25.0
SEED = 2024
MARK = "▁"

#: Bytes of text that are cut into pieces at a time; the arrays of a slice take many times as much.
SLICE = 2_000_000
#: Cells of a lattice table that are filled at a time.
CELLS = 1_000_000
SLOT_BITS = 20
#: Words of at most so many characters, all in pieces, are summed without logarithms: no weight gets too small.
PLAIN = 40


def default_model() -> str:
    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """The vocabulary: hashes of all pieces, their ids and log-weights; and the ids of the 256 bytes."""

    def __init__(self, path: str, alpha: float = ALPHA):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = [model.id_to_piece(k) for k in range(len(model))]
        self.byte_ids = np.zeros(256, np.int64)
        names, ids = [], []
        for k, piece in enumerate(self.pieces):
            if model.is_byte(k):
                self.byte_ids[int(piece[3:5], 16)] = k
            elif not (model.is_control(k) or model.is_unknown(k) or model.is_unused(k)) and MARK not in piece[1:]:
                names.append(piece)
                ids.append(k)
        self.raw = [piece.replace(MARK, " ").encode() for piece in self.pieces]
        for byte, k in enumerate(self.byte_ids.tolist()):
            self.raw[k] = bytes([byte])
        size = np.array([len(name) for name in names])
        self.longest = int(size.max())
        self.ids = np.array(ids, np.int64)
        self.weights = np.append(-alpha * np.log(np.arange(len(names)) + 2.0), -np.inf)
        self.byte_weight = alpha * BYTE
        self.keys = np.zeros(len(names), np.uint64)
        for length in np.unique(size):
            same = np.flatnonzero(size == length)
            codes = np.frombuffer("".join(names[k] for k in same).encode("utf-32-le"), np.uint32).reshape(-1, length).astype(np.uint64)
            key = np.zeros(len(same), np.uint64)
            for k in range(length):
                key = self.extend(key, codes[:, k])
            self.keys[same] = key
        # The number of a piece by its key; keys whose slot is taken are in a second, small table.
        self.chances = np.exp(self.weights)
        self.slot = np.zeros(1 << SLOT_BITS, np.int32)
        self.slot[self._spot(self.keys)] = np.arange(len(names))
        self.other = np.flatnonzero(self.slot[self._spot(self.keys)] != np.arange(len(names)))
        self.other = self.other[np.argsort(self.keys[self.other])]
        self.maybe = np.zeros(1 << 14, bool)
        self.maybe[self.keys[self.other] & np.uint64((1 << 14) - 1)] = True

    @staticmethod
    def _spot(keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x94D049BB133111EB)) >> np.uint64(64 - SLOT_BITS)

    @staticmethod
    def extend(value: np.ndarray, codes: np.ndarray) -> np.ndarray:
        return value * np.uint64(0xD6E8FEB86659FD93) + codes + np.uint64(1)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each piece by its key, -1 where it is none."""
        at = self.slot[self._spot(keys)]
        at[self.keys[at] != keys] = -1
        if len(self.other):
            rest = np.nonzero(self.maybe[keys & np.uint64((1 << 14) - 1)] & (at < 0))
            near = np.minimum(np.searchsorted(self.keys[self.other], keys[rest]), len(self.other) - 1)
            at[rest] = np.where(self.keys[self.other[near]] == keys[rest], self.other[near], -1)
        return at


def _utf8_size(codes: np.ndarray) -> np.ndarray:
    return 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)


def lattice(words: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Cumulative probabilities of the last piece's length at each place of ``words`` (n, length), and its piece.

    ``shares[d, j, w]`` is the probability that the last piece of the first ``j + 1`` characters has at most
    ``d + 1``; ``found[d, j, w]`` is that piece, -1 for bytes.
    """
    n, length = words.shape
    deep = min(pieces.longest, length)
    found = np.full((deep, length, n), -1, np.int32)
    key = np.zeros((length, n), np.uint64)
    codes = np.ascontiguousarray(words.T).astype(np.uint64)
    for d in range(deep):  # pieces that begin at each place, one character longer each time
        key = Pieces.extend(key[:length - d], codes[d:])
        found[d, d:] = pieces.find(key)
    bare = found[0] < 0
    plain = length <= PLAIN and not bare.any()
    score = (pieces.chances if plain else pieces.weights)[found]
    if not plain:
        score[0] = np.where(bare, pieces.byte_weight * _utf8_size(words.T), score[0])
    forward = np.ones((length + 1, n)) if plain else np.zeros((length + 1, n))
    shares = np.ones((deep, length, n), np.float32)
    for j in range(length):
        reach = min(deep, j + 1)
        before = forward[j - np.arange(reach)]
        if plain:
            total = np.cumsum(score[:reach, j] * before, axis=0)
            forward[j + 1] = total[-1]
        else:
            paths = score[:reach, j] + before
            top = paths.max(axis=0)
            total = np.cumsum(np.exp(paths - top), axis=0)
            forward[j + 1] = top + np.log(total[-1])
        shares[:reach, j] = total / total[-1]
    return shares, found


def encode(texts: list[str], keys: np.ndarray, pieces: Pieces, seed: int = SEED) -> list[np.ndarray]:
    """One sampled segmentation for each text, as piece ids; ``keys`` (64-bit) seed the draws of each text.

    Every space begins a word, and the text itself does so too.
    """
    filled = np.array([bool(t) for t in texts], bool)
    words = pyarrow.compute.split_pattern(pa.array([t for t in texts if t], pa.large_string()), " ")
    counts = np.zeros(len(texts), np.int64)
    counts[filled] = np.asarray(pyarrow.compute.list_value_length(words), np.int64)
    named = words.flatten().dictionary_encode()
    back = np.asarray(named.indices, np.int64)
    distinct = named.dictionary.to_pylist()
    size = np.array([len(w) for w in distinct], np.int64) + 1
    owner = np.repeat(np.arange(len(texts)), counts)
    place = np.arange(len(back)) - np.repeat(np.cumsum(counts) - counts, counts)  # of each word in its text
    base = mixed(keys.astype(np.uint64)[owner] + mixed(place.astype(np.uint64) + np.uint64(seed % 2**64)))
    # Where each occurrence begins among the characters of all of them; the piece that begins at a character.
    begins = np.cumsum(size[back]) - size[back]
    none = np.iinfo(np.int64).min
    begun = np.full(int(size[back].sum()), none, np.int64)
    occurrences = np.argsort(back, kind="stable")
    upto = np.searchsorted(back[occurrences], np.arange(len(distinct) + 1))
    # Words with control characters, which no piece holds, are kept apart from those summed without logarithms.
    kind = size * 2 + np.array([not w.isprintable() for w in distinct], np.int64)
    for one in np.unique(kind):
        group, length = np.flatnonzero(kind == one), int(one) // 2
        step = max(1, CELLS // int(length * min(pieces.longest, length)))
        for k in range(0, len(group), step):
            chosen = group[k:k + step]
            flat = np.frombuffer("".join([distinct[c] for c in chosen.tolist()]).encode("utf-32-le"), np.uint32)
            table = np.full((len(chosen), length), ord(MARK), np.int64)
            # The mark character itself is no space: it is given a code that no piece has.
            table[:, 1:] = np.where(flat == ord(MARK), 0x110000, flat).reshape(len(chosen), length - 1)
            shares, found = lattice(table, pieces)
            held = upto[chosen + 1] - upto[chosen]
            word = occurrences[runs(upto[chosen], held)]
            row = np.repeat(np.arange(len(chosen)), held)
            at = np.full(len(word), length, np.int64)
            draw, begin = base[word], begins[word]
            while len(row):
                u = (mixed(draw + at.astype(np.uint64)) >> np.uint64(11)).astype(np.float64) * 2.0**-53
                width = np.ones(len(row), np.int64)
                asking = np.arange(len(row))
                for d in range(min(shares.shape[0], length) - 1):
                    asking = asking[shares[d, at[asking] - 1, row[asking]] <= u[asking]]
                    if not len(asking):
                        break
                    width[asking] += 1
                width = np.minimum(width, at)
                piece = found[width - 1, at - 1, row]
                at = at - width
                begun[begin + at] = np.where(piece >= 0, pieces.ids[piece], -1 - table[row, at])
                go = at > 0
                row, at, draw, begin = row[go], at[go], draw[go], begin[go]
    spots = np.flatnonzero(begun != none)
    made = begun[spots]
    made_by = np.repeat(np.arange(len(back)), size[back])[spots]
    rare = np.flatnonzero(made < 0)
    if len(rare):  # characters that no piece holds, as the ids of their bytes
        spelled = [[pieces.byte_ids[b] for b in _char(-1 - int(made[k])).encode()] for k in rare]
        repeat = np.ones(len(made), np.int64)
        repeat[rare] = [len(s) for s in spelled]
        made, made_by = np.repeat(made, repeat), np.repeat(made_by, repeat)
        made[made < 0] = np.concatenate(spelled)
    cuts = np.searchsorted(owner[made_by], np.arange(len(texts) + 1))
    return [made[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _char(code: int) -> str:
    return MARK if code == 0x110000 else " " if code == ord(MARK) else chr(code)


def decode(ids: np.ndarray, pieces: Pieces) -> str:
    """The text of :func:`encode`: marks become spaces, bytes become themselves, the first space goes."""
    return b"".join(map(pieces.raw.__getitem__, ids.tolist()))[1:].decode()


def encoded(docs: DataFrame, model: str | None = None, alpha: float = ALPHA, seed: int = SEED, ids: bool = True) -> DataFrame:
    """``doc_id, n_pieces, ids, ids_crc32, lossless`` for every row of ``docs`` (doc_id, text).

    ``ids_crc32`` is of the ids as little-endian 32-bit integers; ``lossless`` compares the text with the one
    decoded from the ids alone. The draws are seeded by ``doc_id``, so rows that repeat it draw alike; a row
    without an id is seeded by 0. A text that is null or empty has no piece. A very long text is one row of one
    task. Other columns are ignored. ``model`` is the path of the piece file on every executor; without ``ids`` that column is left out.
    """
    model = model or default_model()
    schema = "doc_id long, n_pieces long, ids array<int>, ids_crc32 long, lossless boolean"

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(model, alpha)
        for part in slices(batches, limit=SLICE):
            keys = np.asarray(part.column("doc_id").fill_null(0), np.int64).view(np.uint64)
            texts = part.column("text").to_pylist()
            found = encode(texts, keys, pieces, seed)
            ends = np.concatenate(([0], np.cumsum([len(f) for f in found]))).astype(np.int32)
            out = {
                "doc_id": part.column("doc_id"), "n_pieces": pa.array(np.diff(ends), pa.int64()),
                "ids": pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found).astype(np.int32))) if ids else None,
                "ids_crc32": pa.array([zlib.crc32(f.astype("<u4").tobytes()) for f in found], pa.int64()),
                "lossless": pa.array([decode(f, pieces) == t for f, t in zip(found, texts, strict=True)]),
            }
            yield pa.RecordBatch.from_pydict({name: column for name, column in out.items() if column is not None})

    return id_and_text(docs).mapInArrow(sample, schema if ids else schema.replace("ids array<int>, ", ""))
