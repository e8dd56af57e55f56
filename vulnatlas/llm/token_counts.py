"""Token counts: greedy longest-match word pieces, counted by a linear automaton that builds no piece.

The vocabulary's pieces form a trie: those that begin a word (with the mark before them) and those that go on
inside one. Where a character has no edge, plain longest match would emit pieces and start over. Instead each
node holds what that comes to: ``pops``, the number of pieces emitted, and ``fails``, the node where matching
goes on. So a word is counted in time linear in its length, whatever the pieces.

Words are runs outside white space (``[^\\x20\\x09-\\x0D]+``). A word that cannot be cut whole into pieces counts
as one unknown token, as in word-piece tokenizers.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator

import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from vulnatlas.llm.text import id_and_text, slices

MARK = "▁"
#: Words whose counts a task keeps.
KEPT_WORDS = 200_000


def default_model() -> str:
    return public_tokenizers.path("piece_bpe_32k.model")


def pieces_of(path: str) -> tuple[list[str], list[str]]:
    """Pieces that begin a word (without their mark), and pieces inside a word, of a piece file."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [
        model.id_to_piece(k) for k in range(len(model))
        if not (model.is_byte(k) or model.is_control(k) or model.is_unknown(k) or model.is_unused(k))
    ]
    starts = [p[1:] for p in plain if p.startswith(MARK) and len(p) > 1 and MARK not in p[1:]]
    return starts, [p for p in plain if MARK not in p]


class Automaton:
    """Trie of both kinds of pieces with failure links and counts of popped pieces.

    Node 0 is the root of pieces that begin a word, node 1 of those inside one; -1 stands for no way on.
    """

    def __init__(self, starts: Iterable[str], inside: Iterable[str]):
        self.edges: list[dict[str, int]] = [{}, {}]
        ends = [False, False]
        for root, names in ((0, starts), (1, inside)):
            for name in names:
                node = root
                for char in name:
                    if char not in self.edges[node]:
                        self.edges[node][char] = len(self.edges)
                        self.edges.append({})
                        ends.append(False)
                    node = self.edges[node][char]
                ends[node] = True
        n = len(self.edges)
        self.fails, self.pops = [-1] * n, [0] * n
        # Parents come before their children, as a link and its count follow from the parent's.
        queue = deque([0, 1])
        while queue:
            parent = queue.popleft()
            for char, node in self.edges[parent].items():
                queue.append(node)
                if ends[node]:  # the whole match is a piece: emit it and go on inside the word
                    self.fails[node], self.pops[node] = 1, 1
                    continue
                at, popped = self.fails[parent], self.pops[parent]
                while at >= 0 and char not in self.edges[at]:
                    popped += self.pops[at]
                    at = self.fails[at]
                if at >= 0:
                    self.fails[node], self.pops[node] = self.edges[at][char], popped

    def count(self, word: str) -> int:
        """Pieces of the word by greedy longest match; 1 if they cannot make up all of it, 0 for an empty one."""
        if not word:
            return 0
        edges, fails, pops = self.edges, self.fails, self.pops
        node = total = 0
        for char in word:
            while (way := edges[node].get(char)) is None:
                total += pops[node]
                node = fails[node]
                if node < 0:
                    return 1
            node = way
        while node != 1:
            total += pops[node]
            node = fails[node]
            if node < 0:
                return 1
        return total


class _Counts(dict):
    """Counts of words, found when first asked for."""

    def __init__(self, automaton: Automaton):
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        found = self[word] = self.automaton.count(word.decode())
        return found


def token_counts(docs: DataFrame, model: str | None = None) -> DataFrame:
    """``doc_id, n_words, n_tokens`` for every row of ``docs`` (doc_id, text), over its whole text.

    A text that is null, empty or white space has no token. Repeated rows and rows without an id get a row
    each. Other columns are ignored. ``model`` is the path of the piece file on every executor.
    """
    model = model or default_model()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _Counts(Automaton(*pieces_of(model)))
        for part in slices(batches):
            words = [text.as_buffer().to_pybytes().split() for text in part.column("text")]
            totals = [sum(map(counts.__getitem__, row)) for row in words]
            if len(counts) > KEPT_WORDS:
                counts.clear()
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(map(len, words), pa.int64()), pa.array(totals, pa.int64())],
                names=["doc_id", "n_words", "n_tokens"])

    return id_and_text(docs).mapInArrow(count, "doc_id long, n_words long, n_tokens long")
