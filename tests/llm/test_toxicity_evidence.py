"""Toxic texts known by what adds up over a text, in all languages, and machines trained on few labelled texts."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from vulnatlas.llm import toxicity as T


def test_all_languages_on_held_out_texts(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{name}.parquet") for name in ("documents", "labels"))
    rows = T.judged(T.toxicity_scores(docs, T.trained(docs, labels)), 5, 0).filter("held_out")
    rows = rows.join(labels, "doc_id").join(docs.select("doc_id", "lang"), "doc_id")
    right = {(r.lang, r.toxic): (r.right, r.n) for r in rows.groupBy("lang", "toxic").agg(
        F.sum((F.col("predicted") == F.col("toxic")).cast("int")).alias("right"), F.count(F.lit(1)).alias("n")).collect()}
    for (lang, toxic), (found, n) in right.items():
        assert found >= (0.85 if toxic else 0.9) * n, (lang, toxic, found, n)
    assert sum(k for k, _ in right.values()) >= 0.98 * sum(n for _, n in right.values())


def test_a_repeated_stem_adds_up():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("aeiou") + rng.choice("bcdfghlmnprstv") for _ in range(rng.randrange(1, 4)))
    texts, labels = [], []
    for k in range(900):
        parts = [word() for _ in range(80)]
        for _ in range(4 if k % 3 == 0 else k % 2):
            parts[rng.randrange(80)] = "krulb" + word()
        texts.append(" ".join(parts))
        labels.append(int(k % 3 == 0))
    model = T.train(texts[:600], np.array(labels[:600]))
    assert ((model.scores(texts[600:]) >= 0.5) == np.array(labels[600:])).mean() > 0.95


def test_few_labelled_texts_train_a_machine(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet") for name in ("documents", "labels"))
    kept = corpus_pipeline.without_toxic(spark, docs, "/root/testdata/sf0.001").select("doc_id")
    known = labels.join(docs.filter("lang = 'en'").select("doc_id"), "doc_id")
    toxic, clean = (known.filter(F.col("toxic") == y) for y in (1, 0))
    assert toxic.join(kept, "doc_id").count() <= 0.3 * toxic.count()
    assert clean.join(kept, "doc_id").count() >= 0.95 * clean.count()
