"""The two trained classifiers: held-out accuracy, the kernel against its definition, awkward rows."""

from __future__ import annotations

import random
from itertools import combinations
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vulnatlas.llm import quality_classifier as Q
from vulnatlas.llm import toxicity as T
from vulnatlas.llm.text import text_bytes

SF_DIR = "/root/testdata/sf0.1"


def symbols(word):
    return np.frombuffer(bytes(ord(c) - 96 for c in word), np.uint8)


def kernel(s, t):
    """Subsequences of three characters within the span, by trying all places."""

    def features(w):
        out = {}
        for i, j, k in combinations(range(len(w)), 3):
            if k - i < T.SPAN:
                out[w[i], w[j], w[k]] = out.get((w[i], w[j], w[k]), 0) + T.DECAY ** (k - i + 1)
        return out

    a, b = features(s), features(t)
    norm = np.sqrt(T.self_kernel(np.array(len(s))) * T.self_kernel(np.array(len(t))))
    return sum(a[u] * b.get(u, 0) for u in a) / norm


@pytest.mark.parametrize("s, t", [("idiot", "idixot"), ("idiot", "idiot"), ("ab", "abc"), ("aaaa", "aaa"), ("abcdefghijkl", "acegikabcdef"), ("abc", "xyz")])
def test_scores_are_kernel_values(s, t):
    got = T.unit_scores(symbols(s), np.array([0]), np.array([len(s)]), T.landmark_weights(symbols(t)))
    assert got[0] == pytest.approx(kernel(s, t), rel=1e-5)


def test_units():
    units = T.units_of(["Él i d i o t, x-y!", "", "a b", "q"], T.symbol_table())
    words = [bytes(units.symbols[a:a + n] + 96).decode() for a, n in zip(units.first, units.size, strict=True)]
    assert words == ["el", "idiot", "xy", "a", "b", "q"] and units.before.tolist() == [0, 3, 3, 5, 6]


def test_gapped_and_inserted_insults_are_found():
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("aeiou") + rng.choice("bcdfghlmnprstv") for _ in range(rng.randrange(1, 4)))
    bad = ["snorkwit", "blatherhog", "grumpfool"]
    texts, labels = [], []
    for k in range(900):
        parts = [word() for _ in range(60)]
        if k % 3 == 0:
            parts[rng.randrange(60)] = rng.choice(bad)
        texts.append(" ".join(parts))
        labels.append(int(k % 3 == 0))
    model = T.train(texts[:600], np.array(labels[:600]))
    assert ((model.scores(texts[600:]) >= 0.5) == np.array(labels[600:])).mean() > 0.98
    clean = " ".join(word() for _ in range(40))
    for insult in ("s n o r k w i t", "sn-ork-wit", "snorkkwit", "SNORKWIT!", "blathxerhog", "grum.pfool"):
        assert model.scores([f"{clean} {insult} {clean}"])[0] >= 0.5, insult
    assert (model.scores([clean, "", "!!"]) < 0.5).all()


@pytest.mark.parametrize("which", ["toxic", "quality"])
def test_held_out_accuracy(spark, which):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{name}.parquet") for name in ("documents", "labels"))
    if which == "toxic":
        scores, parts, held = T.toxicity_scores(docs, T.trained(docs, labels)), 5, 0
    else:
        scores, parts, held = Q.quality_scores(docs, Q.trained(docs, labels, T.fold(F.col("doc_id"), 3) != 1)), 3, 1
    rows = T.judged(scores, parts, held).join(labels, "doc_id").join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    right, n = rows.agg(F.sum((F.col("predicted") == F.col(which)).cast("int")), F.count(F.lit(1))).first()
    assert right >= 0.98 * n
    assert all(crc32(str(r.doc_id).encode()) % parts == held for r in rows.limit(20).collect())


def test_ngrams_do_not_cross_texts_and_start_at_boundaries():
    def buckets(*texts):
        found = [[] for _ in texts]
        for owner, bucket in Q.buckets_of(*text_bytes(pa.array(texts))):
            for o, b in zip(owner.tolist(), bucket.tolist(), strict=True):
                found[o].append(b)
        return [sorted(f) for f in found]

    assert buckets("ab cd", "é x", "", "q q") == [f for t in ("ab cd", "é x", "", "q q") for f in buckets(t)]
    assert buckets("a  b") == buckets("a  b "[:4]) and Q.REPEATED in buckets("q q")[0] and max(buckets("ab cd")[0]) < Q.BUCKETS


def test_awkward_rows(spark, awkward):
    labels = spark.createDataFrame([(k, k % 2, k % 2) for k in range(1, 9)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    everything = F.col("doc_id") >= 0
    for scores in (T.toxicity_scores(awkward, T.trained(awkward, labels, everything)), Q.quality_scores(awkward, Q.trained(awkward, labels, everything))):
        found = T.judged(scores, 5, 0).collect()
        assert len(found) == awkward.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
        assert not any(r.held_out for r in found if r.doc_id is None)
    none = labels.limit(0)
    model = T.trained(awkward, none)
    assert T.drop_toxic(awkward, model).count() == awkward.count() and T.drop_toxic(awkward, model).columns == awkward.columns
    assert T.toxicity_scores(awkward.limit(0), model).collect() == []
    assert Q.quality_scores(awkward.limit(0), Q.trained(awkward, none, everything)).collect() == []


def plain_buckets(text):
    """Buckets of a text by the definition: words, repeated words, and runs of characters with one boundary for white space."""
    def bucket(key):
        return int(Q.mixed(np.array([key], np.uint64))[0]) >> (64 - Q.BUCKETS.bit_length() + 1)

    words = text.encode().split()
    hashes = [int(Q.span_hashes(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))[0]) for w in words]
    out = [bucket(h) for h in hashes] + [Q.REPEATED for a, b in zip(words, words[1:], strict=False) if a == b]
    codes = [32 if c in " \t\n\x0b\x0c\r" else int.from_bytes(c.encode(), "big") for c in text]
    for width in Q.GRAMS:
        for k in range(len(codes) - width + 1):
            run = codes[k:k + width]
            if 32 not in run[1:-1] and not (run[0] == 32 and run[-1] == 32):
                key = width
                for code in run:
                    key = (key * 0x9E3779B97F4A7C15 + code) % 2**64
                out.append(bucket(key))
    return out


def test_scores_are_plain_means_and_softmax():
    rng = np.random.default_rng(4)
    model = Q.Model(rng.normal(size=Q.REPEATED + 1).astype(np.float32), 0.3)
    texts = ["the cat cat sat", "é  ü\n\nab abc", "", " ", "x", "aaaa aaaa aaaa", "日本 日本 text"]
    for text, score in zip(texts, model.scores(*text_bytes(pa.array(texts))), strict=True):
        logits = [float(model.table[b]) for b in plain_buckets(text)]
        logit = (sum(logits) / len(logits) if logits else 0) + model.constant
        chances = np.exp([0, logit]) / np.exp([0, logit]).sum()
        assert score == pytest.approx(chances[1], rel=1e-5)


def test_training_is_plain_gradient_descent(monkeypatch):
    """The table equals one made by differences of the loss, in whole vectors, a step per text."""
    for name, value in (("BUCKETS", 8), ("REPEATED", 8), ("DIMENSIONS", 2), ("EPOCHS", 2)):
        monkeypatch.setattr(Q, name, value)
    texts = [(np.array([0, 3]), np.array([1.0, 3.0], np.float32)), (np.array([3, 5, 8]), np.array([2.0, 1.0, 1.0], np.float32)), (np.array([7]), np.array([1.0], np.float32))]
    labels, rng = np.array([1, 0, 0]), np.random.default_rng(11)
    v, layer, bias = rng.uniform(-0.5, 0.5, (9, 2)), np.zeros((2, 2)), np.zeros(2)
    weight, step = len(texts) / (2 * np.bincount(labels)), 0

    def loss(v, layer, bias, k):
        buckets, counts = texts[k]
        logits = (counts / counts.sum()) @ v[buckets] @ layer + bias
        return np.log(np.exp(logits).sum()) - logits[labels[k]]

    def slope(k, which, args):
        out, eps = np.zeros_like(args[which]), 1e-5
        for at in np.ndindex(out.shape):
            near = [[a.copy() for a in args] for _ in range(2)]
            near[0][which][at] += eps
            near[1][which][at] -= eps
            out[at] = (loss(*near[0], k) - loss(*near[1], k)) / (2 * eps)
        return out

    for _ in range(2):
        for k in rng.permutation([0, 1, 2]):
            rate = Q.RATE * (1 - step / 6) * min(weight[labels[k]], 10.0)
            step += 1
            buckets, counts = texts[k]
            args = [v, layer, bias]
            dv, dl, db = (slope(k, which, args) for which in range(3))
            # A vector moves by its share's part of the mean's slope times the root of the number of vectors.
            share = counts / counts.sum()
            dv[buckets] *= (len(buckets) ** 0.5)
            v, layer, bias = v - rate * dv, layer - rate * dl, bias - rate * 0.1 * db
            assert share.sum() == pytest.approx(1)
    model = Q.train(texts, labels)
    change = layer[:, 1] - layer[:, 0]
    assert model.table == pytest.approx(v @ change, abs=2e-3) and model.constant == pytest.approx(bias[1] - bias[0], abs=2e-3)
