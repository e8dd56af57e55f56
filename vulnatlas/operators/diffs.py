"""Unified diffs read as lines: file, hunk, side and line numbers of each, searchable by what was added or removed.

A hunk's header says how many old and new lines follow. Running counts along a patch's lines so tell which lines
belong to a hunk, whatever they look like: a removed line ``-- x`` reads ``--- x`` and is no file header. The counts
are windows over the lines of one patch, which is one row before; patches are never grouped with each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vulnatlas.operators.filters import contains

HUNK = r"^@@ -(\d+)(?:,(\d+))? \+(\d+)(?:,(\d+))? @@"
SIDES = {"+": "added", "-": "removed", " ": "context"}


def _number(line: Column, group: int, default: int) -> Column:
    text = F.regexp_extract(line, HUNK, group)
    return F.coalesce(F.try_to_number(F.nullif(text, F.lit("")), F.lit("9999999999")).cast("bigint"), F.lit(default).cast("bigint"))


def _path(line: Column) -> Column:
    """The file of a ``---`` or ``+++`` line, without time stamp and without the ``a/`` or ``b/`` before it."""
    name = F.regexp_extract(line, r"^(?:---|\+\+\+) ([^\t]*)", 1)
    return F.regexp_replace(name, "^[ab]/", "")


def diff_lines(patches: DataFrame, diff: str = "diff") -> DataFrame:
    """A row per line inside a hunk: the columns of ``patches`` but ``diff``, then ``file, hunk, side, old_line, new_line, line``.

    ``hunk`` counts from 1 in its patch; ``old_line`` is null for added lines, ``new_line`` for removed ones; ``line`` is
    without its sign. The file is that of the ``+++`` line, or of the ``---`` line where a file was removed. An empty
    line inside a hunk counts as an empty context line. Null and empty diffs, and text that is no diff, give no row.
    Patches that are alike, or repeat an id, are told apart.
    """
    kept = [name for name in patches.columns if name != diff]
    named = patches.select(F.struct(*(F.col(name) for name in kept)).alias("patch"), F.col(diff).alias("diff"), F.monotonically_increasing_id().alias("number"))
    text = F.regexp_replace(F.regexp_replace("diff", r"\r\n", "\n"), r"\n$", "")
    lines = named.filter("diff IS NOT NULL").select("patch", "number", F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    sign = F.when(F.col("line") == "", " ").otherwise(F.substring("line", 1, 1))
    header = F.col("line").rlike(HUNK)
    lines = lines.withColumns({"sign": sign, "header": header})
    lines = lines.withColumns({
        "old": F.when(~F.col("header") & F.col("sign").isin(" ", "-"), 1).otherwise(0).cast("bigint"),
        "new": F.when(~F.col("header") & F.col("sign").isin(" ", "+"), 1).otherwise(0).cast("bigint"),
    })
    along = Window.partitionBy("number").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    lines = lines.withColumns({"olds": F.sum("old").over(along), "news": F.sum("new").over(along), "hunk": F.sum(F.col("header").cast("bigint")).over(along)})
    start = F.when(F.col("header"), F.struct(
        _number(F.col("line"), 1, 0).alias("old"), _number(F.col("line"), 2, 1).alias("n_old"),
        _number(F.col("line"), 3, 0).alias("new"), _number(F.col("line"), 4, 1).alias("n_new"), F.col("olds").alias("olds"), F.col("news").alias("news")))
    lines = lines.withColumn("start", F.last(start, ignorenulls=True).over(along))
    # Old and new lines of the hunk that came before this one.
    lines = lines.withColumns({
        "past_old": F.col("olds") - F.col("old") - F.col("start.olds"), "past_new": F.col("news") - F.col("new") - F.col("start.news")})
    open_hunk = (F.col("past_old") < F.col("start.n_old")) | (F.col("past_new") < F.col("start.n_new"))
    inside = F.coalesce(~F.col("header") & open_hunk, F.lit(False)) & F.col("sign").isin(*SIDES)
    lines = lines.withColumn("inside", inside)
    outside = ~F.col("inside") & ~F.col("header")
    old_file, new_file = (
        F.last(F.when(outside & F.col("line").startswith(f"{mark} "), _path(F.col("line"))), ignorenulls=True).over(along) for mark in ("---", "+++"))
    lines = lines.withColumns({"old_file": old_file, "new_file": new_file}).filter("inside")
    side = F.create_map(*(F.lit(text) for pair in SIDES.items() for text in pair))[F.col("sign")]
    return lines.select(
        "patch.*", F.when(F.col("new_file") == "/dev/null", F.col("old_file")).otherwise(F.coalesce("new_file", "old_file")).alias("file"), "hunk",
        side.alias("side"), F.when(F.col("old") == 1, F.col("start.old") + F.col("past_old")).alias("old_line"),
        F.when(F.col("new") == 1, F.col("start.new") + F.col("past_new")).alias("new_line"), F.expr("substring(line, 2)").alias("line"))


def changed_lines(patches: DataFrame, text: str, side: str | None = None, file: str | None = None, diff: str = "diff") -> DataFrame:
    """Lines of diffs that contain ``text`` in any case, of one side or both, in files whose path contains ``file``.

    Patches that do not contain the text at all are not cut into lines.
    """
    found = diff_lines(patches.filter(contains(diff, text)), diff).filter(contains("line", text))
    if side:
        found = found.filter(F.col("side") == side)
    return found.filter(contains("file", file)) if file else found
