"""Statistics against brute force, rules learned from planted ones, and that no Python runs."""

from __future__ import annotations

import random
import re
from collections import Counter
from math import log2

from pyspark.sql import functions as F

from vulnatlas.llm import quality_rules as Q


def brute(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen = Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
    covered = {k + j for k in range(len(w) - 2) if seen[tuple(w[k:k + 3])] > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_statistics_equal_brute_force(spark, awkward):
    texts = ["a b c a b c a b c", "x\nx\n \n\nx y\nx", "a b a b a b", "é😀 <b>#1</b> || \x0b\x0c\r z", "a b c d a b\tc", "one", "a a a a", "a a a", " "]
    docs = awkward.select("doc_id", "text").union(spark.createDataFrame(list(enumerate(texts, 100)), "doc_id long, text string"))
    found = sorted((tuple(r)[:6] for r in Q.statistics(docs).collect()), key=repr)
    assert found == sorted(((r.doc_id, *brute(r.text)) for r in docs.collect()), key=repr)
    assert Q.statistics(docs.limit(0)).collect() == []


def planted(spark, n=900):
    """Low quality: many symbols, or short words that are not few; all else is good."""
    words = F.expr("repeat(concat('word', CAST(doc_id % 7 AS STRING), ' x', CAST(doc_id AS STRING), 'y '), 40)")
    text = (
        F.when(F.col("doc_id") % 5 == 0, F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(60)), lambda k: F.concat(k.cast("string"), F.lit("##$ok")))))
        .otherwise(F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(60)), lambda k: F.concat(F.lit("word"), (k * F.col("doc_id") % 997).cast("string"))))))
    docs = spark.range(1, n).withColumnRenamed("id", "doc_id").withColumn("text", text).withColumn("spare", words)
    return docs, docs.select("doc_id", F.when(F.col("doc_id") % 5 == 0, 0).otherwise(1).alias("quality"))


def test_rules_find_what_was_planted(spark, plan):
    docs, labels = planted(spark)
    held = F.col("doc_id") % 3 == 1
    rows = Q.judged(docs, labels, ~held)
    wrong = rows.join(labels, "doc_id").filter(held).filter(F.col("kept") != (F.col("quality") == 1)).count()
    assert wrong == 0 and rows.count() == docs.count()
    text = plan(rows) + plan(Q.statistics(docs))
    assert not re.search("Python|Pandas|Arrow", text)


def test_list_is_ordered(spark):
    rules = [Q.Rule((("a", True, 5.0),)), Q.Rule((("a", True, 1.0), ("b", False, 3.0)))]
    df = spark.createDataFrame([(9.0, 1.0), (2.0, 3.0), (2.0, 4.0), (None, 1.0)], "a double, b double")
    assert [r[0] for r in df.select(Q.decision(rules)).collect()] == [0, 1, None, None]
    assert [r[0] for r in df.limit(1).select(Q.decision([])).collect()] == [None]


def test_without_labels_the_base_rules_decide(spark, awkward):
    labels = spark.createDataFrame([(None, 1), (5, None), (1, 7)], "doc_id long, quality int")
    found = Q.judged(awkward, labels, F.lit(True)).collect()
    assert len(found) == awkward.count() and {(r.doc_id, r.base_failed, r.kept) for r in found if r.doc_id in (2, 5, 8)} == {
        (2, True, False), (5, False, True), (8, True, False)}


def test_rare_and_small_values_are_reached(spark):
    """Low quality: 30 in 600 rows with 1 to 30 symbols; one threshold between the middle and the largest value misses half."""
    words = F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(60)), lambda k: F.concat(F.lit("word"), (k * (F.col("id") + 1) % 997).cast("string"))))
    docs = spark.range(600).select(F.col("id").alias("doc_id"), F.concat(words, F.lit(" "), F.expr("repeat('#', IF(id % 20 = 0, CAST(id DIV 20 AS INT) + 1, 0))")).alias("text"))
    labels = spark.range(600).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 20 == 0, 0).otherwise(1).alias("quality"))
    rows = Q.judged(docs, labels, F.lit(True)).join(labels, "doc_id")
    assert rows.filter("quality = 0 AND kept").count() == 0 and rows.filter("quality = 1 AND NOT kept").count() == 0


def plain_learn(rows, thresholds):
    """The decision list as its definition says it, on rows as dictionaries."""
    def holds(row, conditions):
        return all((row[name] > k) == above for name, above, k in conditions)

    def count(rows, conditions=()):
        chosen = [row["y"] for row in rows if holds(row, conditions)]
        return chosen.count(0), chosen.count(1)

    rules, left = [], rows
    while len(rules) < Q.RULES:
        grown = ()
        while len(grown) < Q.CONDITIONS:
            covered = [row for row in left if not row["prunes"] and holds(row, grown)]
            p0, n0 = count(covered)
            gains = []
            for name in Q.FEATURES if p0 and n0 else ():
                for k in range(len(thresholds[name])):
                    for above in (True, False):
                        p, n = count(covered, ((name, above, k),))
                        if p:
                            gains.append((p * (log2(p / (p + n)) - log2(p0 / (p0 + n0))), (name, above, k)))
            best = max(gains, key=lambda g: g[0], default=(0, None))
            if best[0] <= 1e-9:
                break
            grown += (best[1],)
        prunes = [row for row in left if row["prunes"]]
        worth = [(p - n) / (p + n) if p + n else -1 for p, n in (count(prunes, grown[:k + 1]) for k in range(len(grown)))]
        while len(grown) > 1 and worth[len(grown) - 2] >= worth[len(grown) - 1]:
            grown = grown[:-1]
        p, n = count(prunes, grown)
        if not grown or not p or p < Q.PRECISION * (p + n):
            return rules
        rules.append(Q.Rule(tuple((name, above, thresholds[name][k]) for name, above, k in grown)))
        left = [row for row in left if not holds(row, grown)]
    return rules


def test_the_list_equals_its_definition(spark):
    rng = random.Random(9)
    rows = []
    for k in range(500):
        bins = {name: rng.randrange(4) for name in Q.FEATURES}
        low = bins["n_words"] == 3 and bins["word_length"] > 0 or bins["symbol_share"] > 2 or rng.random() < 0.04
        rows.append(bins | {"y": int(not low), "prunes": k % 3 == 0})
    thresholds = {name: [0.5, 1.5, 2.5] for name in Q.FEATURES}
    want = plain_learn(rows, thresholds)
    assert len(want) >= 2 and any(len(rule.conditions) > 1 for rule in want)
    assert Q.learn(spark.createDataFrame(rows), thresholds) == want
    assert Q.learn(spark.createDataFrame(rows).limit(0), thresholds) == []
