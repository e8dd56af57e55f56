"""Toxic texts: a support vector machine over a subsequence string kernel with Nyström landmarks.

A text is cut into units: words of letters and digits, lower-cased, accents and punctuation dropped; three
or more letters in a row that stand alone (``i d i o t``) form one unit. The kernel of two units counts the
subsequences of three characters that they share, within ``SPAN`` characters, each weighted by ``DECAY`` to the
power of its span; so an insult that is gapped, or that holds inserted or replaced characters, still shares
most of its subsequences. The kernel of two texts is the sum over all pairs of their units, each divided by the
self-kernel of a unit of that length: what a text repeats adds up, whatever the language.

Training (in one task, from a bounded sample) is on whole texts with their labels, as the tables label no smaller
passages. Nyström landmarks are texts of both labels; the machine is a support vector machine in their space, and
since the kernel is a sum it comes to one table of weights over subsequences, which scores any unit and, summed,
any text. Most units of a toxic text are like anybody's, so two machines are trained: the first hears all units,
the second only the few that the first finds most telling, as a share of the root of the text's length. The
second one's sum is the text's evidence. Where evidence means toxic is settled on texts that the machines did not
see: training is repeated without each third of the sample, whose evidence then counts. All of it holds alike for
any number of labelled texts.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vulnatlas.llm.text import combined, give_back, id_and_text, in_slices, mixed, runs, slices, span_hashes, text_bytes, word_spans

SPAN = 8
DECAY = 0.5
SYMBOLS = 40
#: At most so many labelled texts of each class are sampled, by the smallest hash of their id.
SAMPLE = 2500
#: Texts that serve as landmarks, half of them of each label.
LANDMARKS = 800
#: Texts whose vectors are held at a time.
BLOCK = 64
#: Weight of the machine's length against its errors.
RATE = 2e-4
#: Share of all units that the second machine does not hear.
HEARD = 0.97
#: Parts of the sample, each of which is scored by machines that did not see it.
PARTS = 3
#: How many times the share of clean texts found toxic counts against the share of toxic ones missed.
CLEAN_WEIGHT = 5
#: The most that the centre may be.
HALF = 0.5
#: Steepness of the score around the centre.
SLOPE = 4.0

_SKIP, _GAP = 255, 254


def _symbol(code: int) -> int:
    char = chr(code)
    if char.isspace():
        return _GAP
    if char.isdigit():
        return SYMBOLS - 1
    if not char.isalpha():
        return _SKIP
    base = unicodedata.normalize("NFKD", char.lower())[0]
    return ord(base) - 96 if "a" <= base <= "z" else 27 + code % 12


def symbol_table() -> np.ndarray:
    """The symbol of each code point below 65,536; those above are letters of their own."""
    return np.array([_symbol(k) for k in range(0xD800)] + [_SKIP] * 0x800 + [_symbol(k) for k in range(0xE000, 0x10000)], np.uint8)


@dataclass
class Units:
    """Units of texts: symbols one after the other, where units begin and how long they are, units before each text."""

    symbols: np.ndarray
    first: np.ndarray
    size: np.ndarray
    before: np.ndarray


def units_of(texts: list[str], table: np.ndarray) -> Units:
    lengths = np.array([len(t) for t in texts], np.int64)
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), np.uint32)
    symbols = np.where(codes < len(table), table[np.minimum(codes, len(table) - 1)], 27 + codes % 12).astype(np.uint8)
    text_of = np.repeat(np.arange(len(texts)), lengths)
    kept = symbols != _SKIP
    symbols, text_of = symbols[kept], text_of[kept]
    letter = symbols != _GAP
    # The number of the run of letters each symbol is in; runs end at white space and between texts.
    fresh = letter.copy()
    fresh[1:] &= ~letter[:-1] | (text_of[1:] != text_of[:-1])
    symbols, text_of, fresh = symbols[letter], text_of[letter], fresh[letter]
    first = np.flatnonzero(fresh)
    size = np.diff(np.append(first, len(symbols)))
    owner = text_of[first]
    if len(first):
        # Letters that stand alone, three or more in a row, are one unit.
        alone = size == 1
        joins = np.zeros(len(first), bool)
        joins[1:] = alone[1:] & alone[:-1] & (owner[1:] == owner[:-1])
        starts = np.flatnonzero(~joins)
        spelled = np.diff(np.append(starts, len(first)))
        joins &= np.repeat(spelled >= 3, spelled)
        first = first[~joins]
        size = np.diff(np.append(first, len(symbols)))
        owner = owner[~joins]
    return Units(symbols, first, size, np.searchsorted(owner, np.arange(len(texts) + 1)))


def _pairs() -> list[tuple[int, int]]:
    return [(a, b) for b in range(2, SPAN) for a in range(1, b)]


def self_kernel(size: np.ndarray) -> np.ndarray:
    """The kernel of a unit of ``size`` distinct symbols with itself; 1 where it has no subsequence."""
    total = sum(np.maximum(size - b, 0) * DECAY ** (2 * (b + 1)) for _, b in _pairs())
    return np.where(total > 0, total, 1.0)


def unit_scores(symbols: np.ndarray, first: np.ndarray, size: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """For each unit the sum of ``weights`` over its subsequences, decayed by span and divided by its length's norm.

    ``symbols`` holds the units one after the other, without anything between them.
    """
    if not len(first):
        return np.zeros(0, np.float32)
    left = np.repeat(first + size, size) - np.arange(len(symbols))  # symbols left in the unit, this one included
    s = symbols.astype(np.int32)
    total = np.zeros(len(symbols) + 1, np.float64)
    for b in range(2, SPAN):
        at = np.flatnonzero(left > b)
        if not len(at):
            break
        ends = s[at] * (SYMBOLS * SYMBOLS) + s[at + b]
        value = weights[ends + s[at + 1] * SYMBOLS].copy()
        for a in range(2, b):
            value += weights[ends + s[at + a] * SYMBOLS]
        total[at] += value * DECAY ** (b + 1)
    sums = np.add.reduceat(total[:-1], first)
    return (sums / np.sqrt(self_kernel(size))).astype(np.float32)


def landmark_weights(symbols: np.ndarray) -> np.ndarray:
    """The table whose scores are the kernel values with one unit."""
    weights = np.zeros(SYMBOLS**3, np.float64)
    s = symbols.astype(np.int64)
    for a, b in _pairs():
        if len(s) > b:
            codes = s[:-b] * SYMBOLS * SYMBOLS + s[a:len(s) - b + a] * SYMBOLS + s[b:]
            np.add.at(weights, codes, DECAY ** (b + 1))
    return weights / np.sqrt(self_kernel(np.array(len(s))))


def _packed(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    size = np.array([len(w) for w in words], np.int64)
    return np.frombuffer(b"".join(words), np.uint8), np.cumsum(size) - size, size


def _support_vectors(z: np.ndarray, y: np.ndarray, weight: np.ndarray, rate: float = 1e-4, steps: int = 400) -> np.ndarray:
    """A linear machine with squared hinge loss, by Newton steps on the examples inside the margin."""
    x = np.hstack([z, np.ones((len(z), 1))])
    w = np.zeros(x.shape[1])
    ridge = rate * np.eye(len(w))
    ridge[-1, -1] = 1e-9
    for step in range(steps):
        inside = y * (x @ w) < 1
        part = x[inside] * weight[inside, None]
        new = np.linalg.solve(part.T @ x[inside] + ridge, part.T @ y[inside])
        if np.allclose(new, w, atol=1e-8):
            break
        w = new if step < 20 else (w + new) / 2
    return w


def _codes(units: Units, table: np.ndarray | None = None, level: float = 0.0) -> Iterator[np.ndarray]:
    """Each text's vector of subsequences: the sum of its units' normed ones, or of those that ``table`` scores above ``level``."""
    heard = np.ones(len(units.first), bool) if table is None else unit_scores(units.symbols, units.first, units.size, table) > level
    for p, q in zip(units.before[:-1], units.before[1:], strict=True):
        first, size = units.first[p:q][heard[p:q]], units.size[p:q][heard[p:q]]
        s = units.symbols[runs(first, size)].astype(np.int64)
        left = np.repeat(np.cumsum(size), size) - np.arange(len(s))
        norm = np.repeat(1 / np.sqrt(self_kernel(size)), size)
        codes, weights = [np.zeros(0, np.int64)], [np.zeros(0)]
        for a, b in _pairs():
            at = np.flatnonzero(left > b)
            codes.append((s[at] * SYMBOLS + s[at + a]) * SYMBOLS + s[at + b])
            weights.append(norm[at] * DECAY ** (b + 1))
        yield np.bincount(np.concatenate(codes), np.concatenate(weights), SYMBOLS**3)


def _vectors(texts: list[str], table: np.ndarray, gate: np.ndarray | None = None, level: float = 0.0) -> np.ndarray:
    """The vectors of texts: of length one, or, of the units above the gate's level, divided by the root of all units."""
    units = units_of(texts, table)
    out = np.empty((len(texts), SYMBOLS**3), np.float32)
    for k, vector in enumerate(_codes(units, gate, level)):
        out[k] = vector
    scale = np.linalg.norm(out, axis=1) if gate is None else np.sqrt(np.diff(units.before))
    out /= np.maximum(scale, 1e-9)[:, None].astype(np.float32)
    return out


def _machine(texts: list[str], y: np.ndarray, table: np.ndarray, gate: np.ndarray | None = None, level: float = 0.0) -> tuple[np.ndarray, float]:
    """Table of weights and constant of the machine over texts labelled 1 and -1, from landmarks of both."""
    chosen = np.concatenate([_evenly(np.flatnonzero(y == side), LANDMARKS // 2) for side in (1, -1)])
    landmarks = np.empty((len(chosen), SYMBOLS**3), np.float32)
    for k in range(0, len(chosen), BLOCK):
        landmarks[k:k + BLOCK] = _vectors([texts[n] for n in chosen[k:k + BLOCK]], table, gate, level)
    kernel = np.concatenate([_vectors(texts[k:k + BLOCK], table, gate, level) @ landmarks.T for k in range(0, len(texts), BLOCK)]).astype(np.float64)
    among = kernel[chosen]
    among = (among + among.T) / 2
    values, vectors = np.linalg.eigh(among)
    good = values > 1e-6 * max(values.max(), 1e-12)
    project = vectors[:, good] / np.sqrt(values[good])
    z = kernel @ project
    unit = np.sqrt(max(1e-12, (z**2).sum(axis=1).mean()))
    balance = np.where(y > 0, (y < 0).sum() / max(1, (y > 0).sum()), 1.0)
    w = _support_vectors(z / unit, y, balance / len(y), RATE)
    return ((project @ w[:-1] / unit).astype(np.float32) @ landmarks).astype(np.float64), float(w[-1])


def _evenly(items: np.ndarray, n: int) -> np.ndarray:
    return items if len(items) <= n else items[np.linspace(0, len(items) - 1, n).astype(int)]


@dataclass
class Model:
    """Both machines' tables, the level from which the second hears a unit, its constant, and the curve of the evidence."""

    gate: np.ndarray
    level: float
    weights: np.ndarray
    constant: float
    centre: float
    slope: float
    table: np.ndarray

    def evidence(self, texts: list[str]) -> np.ndarray:
        """The second machine's value; the constant for a text without a unit."""
        units = units_of(texts, self.table)
        words, back = _distinct(units)
        heard = unit_scores(*words, self.gate) > self.level
        values = np.where(heard, unit_scores(*words, self.weights), 0.0)[back]
        owner = np.repeat(np.arange(len(texts)), np.diff(units.before))
        return np.bincount(owner, values, len(texts)) / np.sqrt(np.maximum(1, np.diff(units.before))) + self.constant

    def scores(self, texts: list[str]) -> np.ndarray:
        """From 0 to 1; a text without a unit gets the score of no evidence."""
        return 1 / (1 + np.exp(-np.clip(self.slope * (self.evidence(texts) - self.centre), -30, 30)))


def _distinct(units: Units) -> tuple[tuple[np.ndarray, np.ndarray, np.ndarray], np.ndarray]:
    """The distinct units, by a 64-bit hash of symbols and length, and which of them each unit is."""
    power = np.multiply.accumulate(np.append(np.uint64(1), np.full(len(units.symbols), 0x9E3779B97F4A7C15, np.uint64)))
    within = np.arange(len(units.symbols)) - np.repeat(units.first, units.size)
    terms = np.append((units.symbols.astype(np.uint64) + np.uint64(1)) * power[within], np.uint64(0))
    keys = np.add.reduceat(terms, units.first) if len(units.first) else np.zeros(0, np.uint64)
    _, one, back = np.unique(keys, return_index=True, return_inverse=True)
    size = units.size[one]
    return (units.symbols[runs(units.first[one], size)], np.cumsum(size) - size, size), back


def _unlike(texts: list[str], labels: np.ndarray) -> tuple[list[str], np.ndarray]:
    """The texts without copies and near copies of earlier ones, whose words would else look like marks of their label."""
    seen, kept = set(), []
    for k, text in enumerate(texts):
        data, offsets = text_bytes(pa.array([text]))
        starts, ends, _ = word_spans(data, offsets)
        grams = combined(span_hashes(data, starts, ends), min(3, len(starts)) or 1)
        marks = {int(mixed(grams ^ np.uint64(n * 0x9E3779B97F4A7C15 % 2**64)).min()) for n in range(4)} if len(grams) else {0}
        if not marks & seen:
            kept.append(k)
        seen |= marks
    return [texts[k] for k in kept], labels[kept]


def train(texts: list[str], labels: np.ndarray) -> Model:
    """The machine from texts labelled 1 (toxic) or 0; without texts of both labels it finds nothing toxic."""
    table = symbol_table()
    texts, labels = _unlike(texts, labels)
    if not len(labels) or labels.min() == labels.max():
        none = np.zeros(SYMBOLS**3, np.float32)
        return Model(none, 0.0, none, 0.0, 1.0, SLOPE, table)
    model = _both_machines(texts, labels, table)
    part = np.zeros(len(texts), int)
    for side in (0, 1):
        part[labels == side] = np.arange((labels == side).sum()) % PARTS
    unseen, known = [], []
    for k in range(PARTS):
        learn, rest = np.flatnonzero(part != k), np.flatnonzero(part == k)
        if len(rest) and 0 < labels[learn].sum() < len(learn):
            one = _both_machines([texts[i] for i in learn], labels[learn], table)
            unseen.append(_evidence(one, [texts[i] for i in rest]))
            known.append(labels[rest])
    # Toxic texts that trained lie at the margin, 1: up to half of it they stay so, also where few texts show how others fare.
    model.centre = min(HALF, _centre(np.concatenate(unseen), np.concatenate(known))) if unseen else 0.0
    return model


def _both_machines(texts: list[str], labels: np.ndarray, table: np.ndarray) -> Model:
    y = np.where(labels == 1, 1.0, -1.0)
    gate, _ = _machine(texts, y, table)
    scored = [np.zeros(0, np.float32)]
    for k in range(0, len(texts), BLOCK):
        units = units_of(texts[k:k + BLOCK], table)
        scored.append(unit_scores(units.symbols, units.first, units.size, gate))
    scored = np.concatenate(scored)
    level = float(np.quantile(scored, HEARD)) if len(scored) else 0.0
    weights, constant = _machine(texts, y, table, gate, level)
    return Model(gate.astype(np.float32), level, weights.astype(np.float32), constant, 0.0, SLOPE, table)


def _evidence(model: Model, texts: list[str]) -> np.ndarray:
    return np.concatenate([model.evidence(texts[k:k + BLOCK]) for k in range(0, len(texts), BLOCK)])


def _centre(values: np.ndarray, y: np.ndarray) -> float:
    """The evidence with the smallest shares of errors, of equal ones that in the widest gap."""
    if y.min() == y.max():
        return 0.0
    order = np.argsort(values, kind="stable")
    values, y = values[order], y[order]
    missed, false = np.append(0, np.cumsum(y == 1)) / (y == 1).sum(), np.append(np.cumsum((y == 0)[::-1])[::-1], 0) / (y == 0).sum()
    errors = missed + CLEAN_WEIGHT * false
    # Values may tie: only gaps between different ones can part them.
    gaps = np.flatnonzero(np.diff(values) > 0) + 1
    if not len(gaps):
        return float(values[0])
    k = min(gaps, key=lambda g: (errors[g], values[g - 1] - values[g]))
    return float((values[k - 1] + values[k]) / 2)


def fold(doc_id: Column, parts: int) -> Column:
    """``crc32`` of the id as text, modulo ``parts``; null for a null id."""
    return F.crc32(doc_id.cast("long").cast("string").cast("binary")) % parts


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, trains: Column, per_class: int) -> DataFrame:
    """``doc_id, text, y`` of at most ``per_class`` texts of label 0 and of label 1, those whose ids have the smallest hashes.

    A repeated id or label counts once, with the larger label; null ids and labels are left out.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
    known = known.filter("doc_id IS NOT NULL AND y IN (0, 1)").filter(trains).groupBy("doc_id").agg(F.max("y").alias("y"))
    ids = id_and_text(docs).select("doc_id").distinct()
    known = known.join(ids, "doc_id", "left_semi")
    picked = None
    for y in (0, 1):
        part = known.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        picked = part if picked is None else picked.union(part)
    return id_and_text(docs).join(picked, "doc_id").groupBy("doc_id").agg(F.max("text").alias("text"), F.max("y").alias("y"))


def trained(docs: DataFrame, labels: DataFrame, trains: Column | None = None) -> Model:
    """The machine from the labelled texts whose ids meet ``trains``: by default those outside the held-out fifth.

    One task trains it, from the bounded sample, so that the driver gets the tables of weights alone.
    """
    trains = fold(F.col("doc_id"), 5) != 0 if trains is None else trains

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "y")), strict=True))
        model = train([text for _, text, _ in rows], np.array([y for *_, y in rows], np.int64))
        rows.clear()
        give_back()
        yield pa.RecordBatch.from_pydict({
            "gate": [model.gate.astype("<f4").tobytes()], "level": [float(model.level)],
            "weights": [model.weights.astype("<f4").tobytes()], "constant": [float(model.constant)], "centre": [float(model.centre)]})

    sample = labelled_sample(docs, labels, "toxic", trains, SAMPLE).repartition(1)
    found = sample.mapInArrow(fit, "gate binary, level double, weights binary, constant double, centre double").collect()
    if not found:  # no labelled text at all
        return train([], np.zeros(0, np.int64))
    gate, weights = (np.frombuffer(found[0][name], "<f4") for name in ("gate", "weights"))
    return Model(gate, found[0].level, weights, found[0].constant, found[0].centre, SLOPE, symbol_table())


def toxicity_scores(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` for every row of ``docs`` (doc_id, text), by text alone.

    A text that is null, empty or without letters and digits gets the low score of no evidence. Repeated
    rows and rows without an id get a row each. Other columns are ignored.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, limit=1_000_000):
            values = model.scores(part.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(values, pa.float64())], names=["doc_id", "score"])

    return id_and_text(docs).mapInArrow(score, "doc_id long, score double")


def judged(scores: DataFrame, parts: int, held: int) -> DataFrame:
    """``doc_id, held_out, score, predicted``; a row without an id is in no fold."""
    return scores.select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), parts) == held, F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that the machine does not find toxic, with all their columns.

    Each row is judged by its own text, repeated ones and those without an id too; null and empty texts stay.
    """

    @F.pandas_udf("double")
    def score(texts):
        return texts.__class__(in_slices([t or "" for t in texts], model.scores))

    return docs.filter(score(docs["text"].cast("string")) < 0.5)
