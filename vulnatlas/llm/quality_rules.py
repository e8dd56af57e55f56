"""Quality rules: statistics of a text, and a decision list learned from labelled ones, all as Spark expressions.

The statistics are SQL expressions over each text alone. For learning, the labelled rows' features are cut at
quantiles of all rows, of the low-quality ones and of values above 0, midway between two values, into bins, which
are stored. Sequential covering grows one rule after the other for low quality: conditions are added by the gain in
information over the growing half, then taken back while that raises (p - n) / (p + n) on the pruning half; a rule
that is right on less than ``PRECISION`` of the pruning half ends the list. For each condition Spark counts the rows
still covered by feature, bin and label: a few hundred numbers, however many rows there are, are all that leaves it.
The list comes out as one ordered CASE expression over thresholds.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vulnatlas.llm.text import id_and_text, remove_stored, stored

WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Most bins of a feature, rules of a list and conditions of a rule; least share of a rule's rows that are low quality.
BINS, RULES, CONDITIONS, PRECISION = 12, 12, 3, 0.8
#: Parts into which quantiles cut the low-quality rows, and the values above 0: a feature that is 0 in most rows has few among BINS.
PARTS = 4

#: What the rules may ask: names of columns made by :func:`features`.
FEATURES = ("symbol_share", "line_share", "repeat_share", "word_length", "n_words", "mark_share", "upper_share")


def _without(column: str, characters: str) -> Column:
    return F.length(F.translate(column, characters, ""))


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` and counts the rules use, of every row.

    ``docs`` (doc_id, text); a null text counts as empty: all of its counts are 0. Repeated rows and rows
    without an id get a row each. Other columns are ignored.
    """
    rows = id_and_text(docs)
    words = F.array_remove(F.split(F.translate("text", WHITE, " " * len(WHITE)), " "), "")
    lines = F.filter(F.split("text", "\n"), lambda line: F.length(F.translate(line, WHITE, "")) > 0)
    counted = rows.select(
        "doc_id", words.alias("words"), _without("text", WHITE).cast("long").alias("word_chars"),
        (F.length("text") - _without("text", SYMBOLS)).cast("long").alias("n_symbols"),
        (F.length("text") - _without("text", "!?")).cast("long").alias("n_marks"),
        (F.length("text") - _without("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")).cast("long").alias("n_upper"),
        lines.alias("lines"),
    )
    counted = counted.select(
        "doc_id", F.size("words").cast("long").alias("n_words"), "word_chars", "n_symbols", "n_marks", "n_upper",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), _windows().alias("windows"),
    )
    repeated = counted.withColumn("windows", F.sort_array("windows"))
    return repeated.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", _covered().cast("long").alias("n_repeat_words"), "n_marks", "n_upper"
    )


def _windows() -> Column:
    """Each three words in a row with their place: ``array<struct<w, p>>``."""
    return F.expr("""
        CASE WHEN size(words) < 3 THEN cast(array() AS array<struct<w: string, p: int>>) ELSE
          zip_with(zip_with(slice(words, 1, size(words) - 2), slice(words, 2, size(words) - 2), (a, b) -> concat(a, ' ', b)),
                   transform(slice(words, 3, size(words) - 2), (c, i) -> named_struct('c', c, 'i', i)),
                   (ab, c) -> named_struct('w', concat(ab, ' ', c.c), 'p', c.i)) END""")


def _covered() -> Column:
    """Words inside windows of sorted ``windows`` whose neighbour is equal."""
    return F.expr("""
        CASE WHEN size(windows) < 2 THEN 0 ELSE size(array_distinct(flatten(filter(
          zip_with(slice(windows, 1, size(windows) - 1), slice(windows, 2, size(windows) - 1),
                   (a, b) -> CASE WHEN a.w = b.w THEN array(a.p, a.p + 1, a.p + 2, b.p, b.p + 1, b.p + 2) END),
          x -> x IS NOT NULL)))) END""")


def features(stats: DataFrame) -> DataFrame:
    """``stats`` with the columns of :data:`FEATURES`."""
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    return stats.withColumns({
        "symbol_share": F.col("n_symbols") / chars, "line_share": F.col("n_dup_lines") / words,
        "repeat_share": F.col("n_repeat_words") / words, "word_length": F.col("word_chars") / words,
        "mark_share": F.col("n_marks") / chars, "upper_share": F.col("n_upper") / chars,
    })


def base_failed() -> Column:
    """Fewer than 50 words, or more than half of them in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Rule:
    """Low quality where every ``(feature, above, threshold)`` holds: feature > threshold, or not."""

    conditions: tuple[tuple[str, bool, float], ...]

    def column(self) -> Column:
        out = F.lit(True)
        for name, above, threshold in self.conditions:
            out = out & (F.col(name) > threshold if above else F.col(name) <= threshold)
        return out


def decision(rules: list[Rule]) -> Column:
    """The ordered conditional: the number of the first rule that holds, null where none does."""
    out = F.lit(None).cast("int")
    for k, rule in reversed(list(enumerate(rules))):
        out = F.when(rule.column(), k).otherwise(out)
    return out


def binned_rows(stats: DataFrame, labels: DataFrame, trains: Column) -> tuple[DataFrame, dict[str, list[float]]]:
    """``y, prunes`` and each feature's bin of the labelled rows that train, stored, and the bins' thresholds.

    A row that fails the base rules trains nothing; a repeated id counts once, with the larger label.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y"))
    known = known.filter("doc_id IS NOT NULL AND y IN (0, 1)").filter(trains).groupBy("doc_id").agg(F.max("y").alias("y"))
    rows = features(stats).filter(~base_failed()).join(known, "doc_id").select("doc_id", "y", *FEATURES)

    def quantiles(of: Column, parts: int) -> Column:
        return F.coalesce(F.percentile_approx(of, F.array(*(F.lit(k / parts) for k in range(parts + 1))), 1000), F.array().cast("array<double>"))

    found = rows.agg(*(
        F.concat(
            quantiles(F.col(name).cast("double"), BINS), quantiles(F.when(F.col("y") == 0, F.col(name)).cast("double"), PARTS),
            quantiles(F.when(F.col(name) > 0, F.col(name)).cast("double"), PARTS)).alias(name)
        for name in FEATURES)).first()
    seen = {name: sorted(set(found[name])) for name in FEATURES}
    thresholds = {name: [(a + b) / 2 for a, b in zip(q, q[1:], strict=False)] for name, q in seen.items()}
    bins = [
        sum((F.when(F.col(name) > t, 1).otherwise(0) for t in thresholds[name]), F.lit(0)).cast("int").alias(name) for name in FEATURES
    ]
    half = (F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0).alias("prunes")
    return stored(rows.select("y", half, *bins), "binned"), thresholds


Condition = tuple[str, bool, int]  # a feature's bin is above a number, or not


def _holds(conditions: tuple[Condition, ...]) -> Column:
    out = F.lit(True)
    for name, above, k in conditions:
        out = out & (F.col(name) > k if above else F.col(name) <= k)
    return out


def _totals(covered: DataFrame, thresholds: dict[str, list[float]]) -> tuple[list[int], list[tuple[Condition, int, int]]]:
    """The low-quality and good rows covered, and those that each condition leaves, from one count by feature and bin."""
    cells = F.explode(F.array(*(F.struct(F.lit(k).alias("feature"), F.col(name).alias("bin")) for k, name in enumerate(FEATURES))))
    found = covered.select("y", cells.alias("c")).groupBy("c.feature", "c.bin", "y").agg(F.count(F.lit(1)).alias("n")).collect()
    bins = [[[0, 0] for _ in range(len(thresholds[name]) + 1)] for name in FEATURES]
    for row in found:
        bins[row.feature][row.bin][row.y] += row.n
    everything, out = [sum(b[y] for b in bins[0]) for y in (0, 1)], []
    for name, counts in zip(FEATURES, bins, strict=True):
        below = [0, 0]
        for k in range(len(thresholds[name])):
            below = [below[y] + counts[k][y] for y in (0, 1)]
            out.append(((name, True, k), everything[0] - below[0], everything[1] - below[1]))
            out.append(((name, False, k), *below))
    return everything, out


def learn(rows: DataFrame, thresholds: dict[str, list[float]]) -> list[Rule]:
    """The decision list from binned rows; for equal gains the first condition in the order of features and thresholds."""
    rules, left = [], rows
    while len(rules) < RULES:
        grown: tuple[Condition, ...] = ()
        while len(grown) < CONDITIONS:
            (p0, n0), totals = _totals(left.filter(~F.col("prunes") & _holds(grown)), thresholds)
            if not p0 or not n0:
                break
            best = None
            for condition, p, n in totals:
                if p:
                    gain = p * (log2(p / (p + n)) - log2(p0 / (p0 + n0)))
                    best = max(best or (0.0, condition), (gain, condition), key=lambda g: g[0])
            if best is None or best[0] <= 1e-9:
                break
            grown += (best[1],)
        if not grown:
            break
        # How the rule and its shorter forms do on the pruning half, in one aggregate.
        forms = [grown[:k] for k in range(1, len(grown) + 1)]
        counts = left.filter("prunes").agg(*(
            F.coalesce(F.sum((_holds(form) & (F.col("y") == y)).cast("long")), F.lit(0)) for form in forms for y in (0, 1))).first()
        worth = [(p - n) / (p + n) if p + n else -1.0 for p, n in zip(counts[::2], counts[1::2], strict=True)]
        size = len(grown)
        while size > 1 and worth[size - 2] >= worth[size - 1]:
            size -= 1
        p, n = counts[2 * size - 2], counts[2 * size - 1]
        if not p or p < PRECISION * (p + n):
            break
        rules.append(Rule(tuple((name, above, thresholds[name][k]) for name, above, k in grown[:size])))
        left = left.filter(~_holds(grown[:size]))
    return rules


def judged(docs: DataFrame, labels: DataFrame, trains: Column) -> DataFrame:
    """:func:`statistics` of every row with ``base_failed``, the number of the learned ``rule`` that holds, and ``kept``.

    Without a labelled row of each kind there is no rule, and the base rules decide alone.
    """
    stats = stored(statistics(docs), "statistics")
    rows, thresholds = binned_rows(stats, labels, trains)
    rules = learn(rows, thresholds)
    remove_stored(rows)
    rule = decision(rules)
    return features(stats).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed().alias("base_failed"),
        (~base_failed() & rule.isNull()).alias("kept"), rule.alias("rule"),
    )
