"""Running sums along ordered groups, and ranks along linked lists, for groups and lists of any length."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vulnatlas.llm.text import remove_stored, stored

#: Index values in a segment: the rows of a group that are summed in one task.
SPAN = 4096
#: One element in so many of a list is a ruler.
RULERS = 8
#: Elements of a list that one task ranks.
SHORT_LIST = 4096


def running(
    df: DataFrame, group: list[str], segment: Column, order: list[str | Column], sums: dict[str, Column],
    fold: Callable[[str], Column] = F.sum, levels: int = 0,
) -> DataFrame:
    """``df`` with the running ``fold`` (a sum or an exclusive or) of each of ``sums`` up to and with the row itself.

    ``segment`` numbers pieces of a group that follow each other in ``order``. Pieces are folded by themselves and
    what comes before a piece is added, so no task holds a group of many pieces. Rows that are equal in ``order`` come
    in any order. ``levels`` folds the pieces in pieces again, for a single group of all rows. ``df`` is read twice.
    """
    names, piece = list(sums), f"_segment{levels}"
    cut = df.withColumn(piece, segment.cast("long"))
    here = Window.partitionBy(*group, piece).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = cut.withColumns(sums).withColumns({name: fold(name).over(here) for name in names})
    totals = cut.groupBy(*group, piece).agg(*(fold(value).alias(f"_{name}") for name, value in sums.items()))
    if levels:
        whole = running(totals, group, F.expr(f"{piece} div {SPAN}"), [piece], {n: F.col(f"_{n}") for n in names}, fold, levels - 1)
        before = whole.select(*group, piece, *((F.col(n) - F.col(f"_{n}")).alias(f"_before_{n}") for n in names))
    else:
        earlier = Window.partitionBy(*group).orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
        before = totals.select(*group, piece, *(fold(f"_{n}").over(earlier).alias(f"_before_{n}") for n in names))
        before = before.filter(F.col(f"_before_{names[0]}").isNotNull())

    def together(name: str) -> Column:
        first = F.coalesce(F.col(f"_before_{name}"), F.lit(0))
        return F.col(name).bitwiseXOR(first) if fold is F.bit_xor else F.col(name) + first

    joined = rows.join(before, [*group, piece], "left")
    return joined.withColumns({name: together(name) for name in names}).drop(piece, *(f"_before_{n}" for n in names))


def _ruler(level: int, *key: str) -> Column:
    return F.pmod(F.xxhash64(F.lit(level), *key), F.lit(RULERS)) == 0


def _short(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Ranks of a list that one task holds, walked from its last element."""
    rows = [row for batch in batches for row in batch.astype("Int64").itertuples(index=False, name=None)]
    after = {(c, t): ((None if nc is pd.NA else (nc, nt)), w) for c, t, nc, nt, w in rows}
    before = {to: key for key, (to, _) in after.items()}
    key, rank, out = before.get(None), 0, []
    while key is not None:
        rank += after[key][1]
        out.append((*key, rank))
        key = before.get(key)
    yield pd.DataFrame(out, columns=["c", "t", "rank"], dtype="int64")


def list_ranks(links: DataFrame, level: int = 0) -> DataFrame:
    """``c, t, rank`` of each element (c, t) of a linked list: how far it is from the end.

    ``links`` has each element once with the one after it (nc, nt), null for the last, and the length ``w`` of that
    step. One element in eight, by its hash, is a ruler. Elements double their steps, by join, until they meet a
    ruler or the end, which takes rounds in the logarithm of the longest gap between rulers and not of the list;
    then the rulers, a list themselves, are ranked in the same way. A list of a few thousand is ranked in a task.
    """
    now = stored(links.select("c", "t", "nc", "nt", "w"), "list")
    if now.count() <= SHORT_LIST:
        return stored(now.repartition(1).mapInPandas(_short, "c long, t long, rank long"), "ranks")
    met = F.col("nc").isNull() | _ruler(level, "nc", "nt")
    while not now.filter(~met).isEmpty():
        ahead = now.select(F.col("c").alias("nc"), F.col("t").alias("nt"), F.col("nc").alias("_c"), F.col("nt").alias("_t"), F.col("w").alias("_w"))
        further = now.filter(~met).join(ahead, ["nc", "nt"]).selectExpr("c", "t", "_c AS nc", "_t AS nt", "w + _w AS w")
        after = stored(now.filter(met).select("c", "t", "nc", "nt", "w").unionByName(further), "list")
        remove_stored(now)
        now = after
    ranks = list_ranks(now.filter(_ruler(level, "c", "t")), level + 1)
    of_ruler = ranks.select(F.col("c").alias("nc"), F.col("t").alias("nt"), F.col("rank").alias("_rank"))
    # Every element, a ruler too, is as far from the end as its step to the next ruler and that one's rank.
    done = now.join(of_ruler, ["nc", "nt"], "left").select("c", "t", (F.col("w") + F.coalesce("_rank", F.lit(0))).alias("rank"))
    done = stored(done, "ranks")
    remove_stored(now, ranks)
    return done
