"""Any Boolean combination of full-text conditions, judged in one pass over the postings.

A condition is a leaf (a word or phrase, a prefix, words near each other, each in one field or any, at the start of
a field or anywhere) or joins others: all of them, any of them, one but not the other. All leaves become flags of
one grouped scan: the postings of the words that occur in any leaf are shuffled once by id, positions meet per
field, flags per row, and the tree is judged on the flags. So a tree of any size costs one shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vulnatlas.operators.postings import query_tokens


@dataclass(frozen=True)
class Words:
    """The words of ``text`` one after the other, in one field or any; ``first``: at the start of the field.

    With ``prefix`` the last word may go on.
    """

    text: str
    field: str | None = None
    first: bool = False
    prefix: bool = False


@dataclass(frozen=True)
class Near:
    """All of the phrases within one field, with at most ``distance`` words between the end of each and the last one's start."""

    phrases: tuple[str, ...]
    distance: int = 10
    field: str | None = None


@dataclass(frozen=True)
class AllOf:
    parts: tuple[Tree, ...]


@dataclass(frozen=True)
class AnyOf:
    parts: tuple[Tree, ...]


@dataclass(frozen=True)
class But:
    """What matches ``wanted`` and not ``unwanted``."""

    wanted: Tree
    unwanted: Tree


Leaf = Words | Near
Tree = Leaf | AllOf | AnyOf | But


def prefix(text: str, field: str | None = None) -> Words:
    return Words(text, field, prefix=True)


def all_of(*parts: Tree | str) -> AllOf:
    return AllOf(tuple(Words(p) if isinstance(p, str) else p for p in parts))


def any_of(*parts: Tree | str) -> AnyOf:
    return AnyOf(tuple(Words(p) if isinstance(p, str) else p for p in parts))


def leaves(tree: Tree) -> Iterator[Leaf]:
    if isinstance(tree, Leaf):
        yield tree
    elif isinstance(tree, But):
        yield from leaves(tree.wanted)
        yield from leaves(tree.unwanted)
    else:
        for part in tree.parts:
            yield from leaves(part)


@dataclass(frozen=True)
class Analyzed:
    """A leaf with its phrases as tokens, by the functions that made the index's tokens."""

    leaf: Leaf
    phrases: tuple[tuple[str, ...], ...]

    @property
    def open_end(self) -> str | None:
        """The token that may go on."""
        return self.phrases[0][-1] if isinstance(self.leaf, Words) and self.leaf.prefix else None

    @property
    def exact(self) -> set[str]:
        words = [word for phrase in self.phrases for word in phrase]
        return set(words[:-1] if self.open_end else words)

    @property
    def plain(self) -> bool:
        """One word anywhere: its positions are not asked for."""
        return isinstance(self.leaf, Words) and len(self.phrases[0]) == 1 and not self.leaf.first


def analyzed(spark, tree: Tree, stem: bool) -> dict[Leaf, Analyzed]:
    """The leaves' tokens. A phrase without a word, or fewer than two characters in all, is an error."""
    wanted = list(dict.fromkeys(leaves(tree)))
    if not wanted:
        raise ValueError("a search needs at least one condition")
    texts = [[leaf.text] if isinstance(leaf, Words) else list(leaf.phrases) for leaf in wanted]
    flat = [text for group in texts for text in group]
    if sum(map(len, flat)) < 2:
        raise ValueError("search terms need at least two characters")
    tokens = iter(query_tokens(spark, flat, stem))
    out = {leaf: Analyzed(leaf, tuple(tuple(next(tokens)) for _ in group)) for leaf, group in zip(wanted, texts, strict=True)}
    for leaf, found in out.items():
        if not found.phrases or not all(found.phrases):
            raise ValueError(f"search terms without letters or digits: {leaf}")
    return out


def judged(tree: Tree, flags: dict[Leaf, Column | bool]):
    """The tree's verdict from those of its leaves: columns, or plain truth values."""
    if isinstance(tree, Leaf):
        return flags[tree]
    if isinstance(tree, But):
        wanted, unwanted = judged(tree.wanted, flags), judged(tree.unwanted, flags)
        return wanted & (~unwanted if isinstance(unwanted, Column) else not unwanted)
    if not tree.parts:
        raise ValueError("a search needs at least one condition")
    verdicts = [judged(part, flags) for part in tree.parts]
    return reduce(lambda a, b: a & b if isinstance(tree, AllOf) else a | b, verdicts)


def required(tree: Tree, words: dict[Leaf, Analyzed]) -> set[str]:
    """Tokens without which nothing matches."""
    if isinstance(tree, Leaf):
        return words[tree].exact
    if isinstance(tree, But):
        return required(tree.wanted, words)
    sets = [required(part, words) for part in tree.parts]
    return set().union(*sets) if isinstance(tree, AllOf) else set.intersection(*sets) if sets else set()


def phrase_starts(positions: list[Column]) -> Column:
    """Positions at which the tokens follow one another."""

    def start(place: int):
        return lambda position: position - place

    return reduce(F.array_intersect, (F.transform(p, start(i)) for i, p in enumerate(positions)))


def near(starts: list[Column], lengths: list[int], distance: int) -> Column:
    """Whether the phrases that begin at ``starts`` occur close together, by one sweep over all starts in order.

    At each start the latest start of every phrase so far is looked at: all of them have to end at most ``distance``
    words before this one begins. The work follows the number of starts, whatever the distance.
    """
    def event(number: int):
        return lambda place: F.struct(place.cast("int").alias("place"), F.lit(number).alias("phrase"))

    events = F.array_sort(F.concat(*(F.transform(p, event(i)) for i, p in enumerate(starts))))
    names = [f"last{i}" for i in range(len(starts))]
    none = F.lit(None).cast("int")
    state = F.struct(*(none.alias(name) for name in names), F.lit(False).alias("met"))

    def step(now: Column, e: Column) -> Column:
        last = [F.when(e["phrase"] == i, e["place"]).otherwise(now[name]) for i, name in enumerate(names)]
        close = reduce(Column.__and__, (
            F.coalesce(seen >= e["place"] - length - distance, F.lit(False)) for seen, length in zip(last, lengths, strict=True)))
        return F.struct(*(seen.alias(name) for seen, name in zip(last, names, strict=True)), (now["met"] | close).alias("met"))

    return F.aggregate(events, state, step, lambda now: now["met"])


def _held(found: Analyzed, positions: dict[str, Column], open_positions: dict[str, Column]) -> Column:
    """Whether one row's field holds the leaf."""
    leaf = found.leaf

    def starts(phrase: tuple[str, ...], open_end: str | None) -> Column:
        columns = [positions[token] for token in phrase[:-1]]
        return phrase_starts([*columns, open_positions[open_end] if open_end else positions[phrase[-1]]])

    begins = [starts(phrase, found.open_end) for phrase in found.phrases]
    if isinstance(leaf, Near):
        every = reduce(Column.__and__, (F.size(b) > 0 for b in begins))
        held = every & near(begins, [len(phrase) for phrase in found.phrases], leaf.distance)
    else:
        held = F.array_contains(begins[0], 0) if leaf.first else F.size(begins[0]) > 0
    if leaf.field:
        held &= F.col("field") == leaf.field
    return F.coalesce(held, F.lit(False))


def match_tree(postings: DataFrame, tree: Tree, stem: bool = True, narrowed: DataFrame | None = None) -> DataFrame:
    """Distinct ``id`` of the rows that match.

    ``stem`` says whether the postings hold stems; the tree's words go through the same functions as the texts, so
    case, accents and endings do not matter. ``narrowed`` holds ids that the result is known to be among. A tree
    that rows without any of its words match, such as nothing but an exclusion, is an error.
    """
    words = analyzed(postings.sparkSession, tree, stem)
    if judged(tree, {leaf: False for leaf in words}):
        raise ValueError("a search needs a condition that rows have to meet")
    exact = sorted(set().union(*(w.exact for w in words.values())))
    opened = sorted({w.open_end for w in words.values() if w.open_end})
    tests = ([F.col("token").isin(exact)] if exact else []) + [F.col("token").startswith(start) for start in opened]
    chosen = postings.filter(reduce(Column.__or__, tests))
    fields = {w.leaf.field for w in words.values()}
    if None not in fields:
        chosen = chosen.filter(F.col("field").isin(sorted(fields)))
    if narrowed is not None:
        chosen = chosen.join(narrowed, "id", "left_semi")

    def here(w: Analyzed) -> Column:
        test = F.col("token").startswith(w.open_end) if w.open_end else F.col("token") == w.phrases[0][0]
        return test & (F.col("field") == w.leaf.field) if w.leaf.field else test

    if all(w.plain for w in words.values()):
        # Single words need no positions: their flags add up before the shuffle.
        per_id = chosen.groupBy("id").agg(*(F.bool_or(here(w)).alias(f"leaf{n}") for n, w in enumerate(words.values())))
    else:
        asked = {f"p{n}": F.first(F.when(F.col("token") == token, F.col("positions")), ignorenulls=True) for n, token in enumerate(exact)}
        asked |= {
            f"o{n}": F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.when(F.col("token").startswith(start), F.col("positions"))))))
            for n, start in enumerate(opened)}
        by_field = chosen.repartition("id").groupBy("id", "field").agg(*(column.alias(name) for name, column in asked.items()))
        positions = {token: F.col(f"p{n}") for n, token in enumerate(exact)}
        ends = {start: F.col(f"o{n}") for n, start in enumerate(opened)}
        per_id = by_field.groupBy("id").agg(*(F.bool_or(_held(w, positions, ends)).alias(f"leaf{n}") for n, w in enumerate(words.values())))
    flags = {leaf: F.col(f"leaf{n}") for n, leaf in enumerate(words)}
    return per_id.filter(judged(tree, flags)).select("id")
