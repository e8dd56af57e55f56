"""Quality classifier: learned vectors of hashed words and character n-grams, averaged per document, with softmax.

Every word and every run of ``GRAMS`` characters of a text (a white space counts as one boundary character)
is hashed to one of ``BUCKETS`` vectors, and each word that repeats the one before has a vector more, which all
such words share; the document is their mean, and a linear layer with softmax gives the
probability of each label. Vectors and layer are trained together by stochastic gradient descent in numpy, in
one task, over a bounded sample of labelled texts whose bucket counts the executors work out.

At scoring time the layer is applied to each vector first: a text's logit is then the mean of one number per
n-gram, so the executors hold one table of ``BUCKETS`` numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vulnatlas.llm.text import SPACE, id_and_text, mixed, slices, span_hashes, text_bytes, word_spans

BUCKETS = 1 << 17
#: The vector of words that repeat the one before, beyond the hashed ones.
REPEATED = BUCKETS
GRAMS = (3, 4)
DIMENSIONS = 8
EPOCHS = 12
RATE = 0.5
#: At most so many labelled texts of each label are sampled, by the smallest hash of their id.
SAMPLE = 2000

SCHEMA = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def buckets_of(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(text, bucket)`` of all words, then of all n-grams of each width, of texts laid one after the other."""
    shift = np.uint64(64 - (BUCKETS.bit_length() - 1))
    starts, ends, first = word_spans(data, offsets)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    words = span_hashes(data, starts, ends)
    yield owner, (mixed(words) >> shift).astype(np.int32)
    again = np.flatnonzero((words[1:] == words[:-1]) & (owner[1:] == owner[:-1]))
    yield owner[again], np.full(len(again), REPEATED, np.int32)
    # Characters as code points; white space and the edges of texts are boundaries.
    lead = (data & 0xC0) != 0x80
    at = np.flatnonzero(lead)
    if not len(at):
        return
    text = np.searchsorted(offsets, at, side="right") - 1
    padded = np.concatenate((data, np.zeros(3, np.uint8))).astype(np.uint64)
    size = np.diff(np.append(at, len(data)))
    code = padded[at]
    for k in range(1, 4):
        code = np.where(size > k, code * np.uint64(256) + padded[at + k], code)
    edge = SPACE[data[at]]
    code[edge] = 32
    for width in GRAMS:
        n = len(code) - width + 1
        if n <= 0:
            return
        key = np.full(n, width, np.uint64)
        inner = np.ones(n, bool)
        for k in range(width):
            key = key * np.uint64(0x9E3779B97F4A7C15) + code[k:k + n]
            if 0 < k < width - 1:
                inner &= ~edge[k:k + n]
        inner &= (text[:n] == text[width - 1:]) & ~(edge[:n] & edge[width - 1:])
        chosen = np.flatnonzero(inner)
        yield text[chosen], (mixed(key[chosen]) >> shift).astype(np.int32)


@dataclass
class Model:
    """One number per bucket, and the constant, of the logit of label 1."""

    table: np.ndarray
    constant: float

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(offsets) - 1
        total, count = np.zeros(n), np.zeros(n)
        for owner, bucket in buckets_of(data, offsets):
            total += np.bincount(owner, self.table[bucket], n)
            count += np.bincount(owner, minlength=n)
        return 1 / (1 + np.exp(-np.clip(total / np.maximum(count, 1) + self.constant, -30, 30)))


def bucket_counts(docs: DataFrame) -> DataFrame:
    """``doc_id, y, buckets, counts`` of labelled rows (doc_id, text, y)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            data, offsets = text_bytes(part.column("text"))
            keys = np.concatenate([owner.astype(np.int64) * (REPEATED + 1) + bucket for owner, bucket in buckets_of(data, offsets)])
            keys, counts = np.unique(keys, return_counts=True)
            cuts = np.searchsorted(keys, np.arange(part.num_rows + 1) * (REPEATED + 1))
            rows = [(keys[a:b] % (REPEATED + 1), counts[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("y"), pa.array([b.astype("<i4").tobytes() for b, _ in rows], pa.binary()),
                 pa.array([c.astype("<f4").tobytes() for _, c in rows], pa.binary())], names=["doc_id", "y", "buckets", "counts"])

    return docs.select("doc_id", "text", "y").mapInArrow(count, "doc_id long, y int, buckets binary, counts binary")


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 11) -> Model:
    """Stochastic gradient descent over texts given as distinct buckets and their counts; labels weigh alike."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (REPEATED + 1, DIMENSIONS)).astype(np.float32)
    layer, bias = np.zeros((DIMENSIONS, 2), np.float32), np.zeros(2, np.float32)
    filled = [k for k, (buckets, _) in enumerate(rows) if len(buckets)]
    weight = len(filled) / (2 * np.maximum(np.bincount(labels[filled], minlength=2), 1)) if filled else np.ones(2)
    shares = {k: (rows[k][0], rows[k][1] / rows[k][1].sum()) for k in filled}
    steps, step = max(1, EPOCHS * len(filled)), 0
    for _ in range(EPOCHS):
        for k in rng.permutation(filled):
            buckets, share = shares[k]
            rate = RATE * (1 - step / steps) * min(weight[labels[k]], 10.0)
            step += 1
            mean = share @ vectors[buckets]
            logits = mean @ layer + bias
            chance = np.exp(logits - logits.max())
            chance /= chance.sum()
            chance[labels[k]] -= 1
            back = layer @ chance
            layer -= rate * np.outer(mean, chance)
            bias -= rate * 0.1 * chance
            # Each n-gram's vector moves by its share of the mean, as if the text had one n-gram per bucket.
            vectors[buckets] -= (rate * share * len(buckets) ** 0.5)[:, None].astype(np.float32) * back
    change = layer[:, 1] - layer[:, 0]
    return Model((vectors @ change).astype(np.float32), float(bias[1] - bias[0]))


def trained(docs: DataFrame, labels: DataFrame, trains: Column) -> Model:
    """The model from at most ``SAMPLE`` texts of each label whose ids meet ``trains``.

    One task trains it; the driver gets a number per bucket. A repeated id counts once, with the larger label and text; null ids and labels are left out.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y"))
    known = known.filter("doc_id IS NOT NULL AND y IN (0, 1)").filter(trains).groupBy("doc_id").agg(F.max("y").alias("y"))
    known = known.join(id_and_text(docs).select("doc_id").distinct(), "doc_id", "left_semi")
    parts = [known.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE) for y in (0, 1)]
    rows = id_and_text(docs).join(parts[0].union(parts[1]), "doc_id").groupBy("doc_id").agg(F.max("text").alias("text"), F.max("y").alias("y"))

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("doc_id", "y", "buckets", "counts")
        found = sorted(row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in names), strict=True))
        pairs = [(np.frombuffer(b, "<i4"), np.frombuffer(c, "<f4")) for *_, b, c in found]
        model = train(pairs, np.array([y for _, y, *_ in found], np.int64))
        yield pa.RecordBatch.from_pydict({"table": [model.table.astype("<f4").tobytes()], "constant": [model.constant]})

    of_label = {r.y: r["count"] for r in known.groupBy("y").count().collect()}
    found = bucket_counts(rows).repartition(1).mapInArrow(fit, "table binary, constant double").collect()
    model = Model(np.frombuffer(found[0].table, "<f4"), found[0].constant) if found else train([], np.zeros(0, np.int64))
    if len(of_label) == 2:  # training weighs the labels alike; the scores follow their shares
        model.constant += float(np.log(of_label[1] / of_label[0]))
    return model


def quality_scores(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` for every row of ``docs`` (doc_id, text), by text alone; higher means good quality.

    A text that is null, empty or white space has no n-gram and gets the model's constant. Repeated rows and
    rows without an id get a row each. Other columns are ignored.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            values = model.scores(*text_bytes(part.column("text")))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(values, pa.float64())], schema=SCHEMA)

    return id_and_text(docs).mapInArrow(score, "doc_id long, score double")
