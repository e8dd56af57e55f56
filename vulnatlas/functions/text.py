"""Tokens of a text as used by the token index and by search terms."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters, digits and private-use characters make up tokens; all else separates them.
TOKEN_PATTERN = r"([\p{L}\p{N}\p{Co}]+)"


def _folding() -> tuple[str, str]:
    """``translate`` arguments: Latin letters to their ASCII base, combining marks to nothing.

    Letters with more than one mark are kept, as the ``unicode61`` tokenizer does.
    """
    accented, base = [], []
    for code in (*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)):
        letter, *marks = unicodedata.normalize("NFD", chr(code).casefold())
        if letter.isascii() and len(marks) < 2 and all(map(unicodedata.combining, marks)):
            accented.append(chr(code))
            base.append(letter)
    marks = "".join(map(chr, range(0x0300, 0x0332)))
    return "".join(accented) + marks, "".join(base)


_ACCENTED, _BASE = _folding()
#: What :func:`fold` does to lower-cased text, for ``str.translate``.
FOLDING = {ord(letter): _BASE[n] if n < len(_BASE) else None for n, letter in enumerate(_ACCENTED)}
#: Tokens before folding: marks that it removes are still among their letters.
MARKED_PATTERN = r"([\p{L}\p{N}\p{Co}\u0300-\u0331]+)"


def fold(text: Column) -> Column:
    return F.translate(F.lower(text), _ACCENTED, _BASE)


def tokens(text: Column) -> Column:
    """Lower-cased, accent-folded tokens in text order; null gives an empty array."""
    return F.regexp_extract_all(fold(F.coalesce(text, F.lit(""))), F.lit(TOKEN_PATTERN), F.lit(1))


def marked_words(text: Column) -> Column:
    """Lower-cased words in text order; each is a token of :func:`tokens` once ``FOLDING`` is applied, or nothing is left of it."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(MARKED_PATTERN), F.lit(1))
