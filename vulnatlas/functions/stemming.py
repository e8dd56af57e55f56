"""Porter (1980) suffix stripping of token arrays with built-in functions.

Each step of the published algorithm is one ``transform`` over the array, so stems come out of
the row that holds the text: no Python workers, no vocabulary join, no shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# A leading ``y`` is a consonant; it is written ``Y`` while the steps run.
_CONS = "[^aeiou][^aeiouy]*"
_VOWEL = "[aeiouy][aeiou]*"
MEASURE_GT_0 = f"^(?:{_CONS})?{_VOWEL}{_CONS}"
MEASURE_EQ_1 = f"^(?:{_CONS})?{_VOWEL}{_CONS}(?:{_VOWEL})?$"
MEASURE_GT_1 = f"^(?:{_CONS})?{_VOWEL}{_CONS}{_VOWEL}{_CONS}"
HAS_VOWEL = f"^(?:{_CONS})?[aeiouy]"
# Measure 1 ending consonant-vowel-consonant, the last one not ``w``, ``x`` or ``y``. Letters outside
# ASCII count as several consonants in a row, so neither pattern ends in one.
SHORT_CVC = rf"^{_CONS}[aeiouy][\x00-\x7f&&[^aeiouwxy]]$"
DOUBLE_CONSONANT = r"(?i)([\x00-\x7f&&[^aeioulsz]])\1$"

# Suffix tables of the published algorithm.
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize",
    "logi": "log", "bli": "ble", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous",
    "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive",
    "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
}
STEP_3 = {
    "icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": "",
}
STEP_4 = dict.fromkeys(
    ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou",
     "ism", "ate", "iti", "ous", "ive", "ize"], "",
)

# Tokens outside these UTF-8 lengths are kept as they are.
MIN_BYTES, MAX_BYTES = 3, 64


def _without(n: int) -> str:
    return f"left(w, length(w) - {n})"


def _case(*branches: tuple[str, str], otherwise: str = "w") -> str:
    """SQL for the value of the first branch whose condition holds, else ``w`` as it is."""
    return "CASE " + " ".join(f"WHEN {test} THEN {value}" for test, value in branches) + f" ELSE {otherwise} END"


def _ends(suffix: str) -> str:
    return f"endswith(w, '{suffix}')"


def _matches(value: str, pattern: str) -> str:
    return f"{value} RLIKE r'{pattern}'"


def _suffix_table(rules: dict[str, str], measure: str, ion_after: str | None = None) -> str:
    """Replace the longest listed suffix if the part before it has the wanted measure."""

    def replaced(suffix: str) -> str:
        before = _without(len(suffix))
        fits = _matches(before, measure)
        if suffix == "ion" and ion_after:
            fits = f"{_matches(before, ion_after)} AND {fits}"
        return _case((fits, f"concat({before}, '{rules[suffix]}')"))

    # Longest first, so that a suffix never hides behind its own ending; by last letter, so that
    # most words are settled after a handful of comparisons.
    by_letter: dict[str, list[str]] = {}
    for suffix in sorted(rules, key=len, reverse=True):
        by_letter.setdefault(suffix[-1], []).append(suffix)
    return _case(*(
        (_ends(letter), _case(*((_ends(suffix), replaced(suffix)) for suffix in suffixes)))
        for letter, suffixes in by_letter.items()
    ))


# The steps as SQL over the word ``w``. Step 1b marks a removed ``ed`` or ``ing`` with a trailing
# ``|``, which the repair after it takes away.
STEPS = (
    _case(("startswith(w, 'y')", "concat('Y', substring(w, 2))")),
    _case(
        (f"NOT {_ends('s')} OR {_ends('ss')}", "w"),
        (_matches("w", "(?:.ss|.i)es$"), _without(2)),
        otherwise=_without(1),
    ),
    _case(
        (_matches("w", ".eed$"), _case((_matches(_without(3), MEASURE_GT_0), _without(1)))),
        (f"{_ends('ed')} AND {_matches(_without(2), HAS_VOWEL)}", f"concat({_without(2)}, '|')"),
        (f"{_ends('ing')} AND {_matches(_without(3), HAS_VOWEL)}", f"concat({_without(3)}, '|')"),
    ),
    _case(
        (f"NOT {_ends('|')}", "w"),
        (_matches(_without(1), "(?:at|bl|iz)$"), f"concat({_without(1)}, 'e')"),
        (_matches(_without(1), DOUBLE_CONSONANT), _without(2)),
        (_matches(_without(1), SHORT_CVC), f"concat({_without(1)}, 'e')"),
        otherwise=_without(1),
    ),
    _case((f"{_ends('y')} AND {_matches(_without(1), HAS_VOWEL)}", f"concat({_without(1)}, 'i')")),
    _suffix_table(STEP_2, MEASURE_GT_0),
    _suffix_table(STEP_3, MEASURE_GT_0),
    _suffix_table(STEP_4, MEASURE_GT_1, ion_after="[st]$"),
    _case((
        f"{_ends('e')} AND ({_matches(_without(1), MEASURE_GT_1)} OR "
        f"({_matches(_without(1), MEASURE_EQ_1)} AND NOT {_matches(_without(1), SHORT_CVC)}))",
        _without(1),
    )),
    _case((f"{_ends('ll')} AND {_matches(_without(1), MEASURE_GT_1)}", _without(1))),
    "lower(w)",
)


def stems(words: str) -> Column:
    """Stem of every element of an array of tokens, given as SQL.

    Every step is its own ``transform``: its variable holds the result of the step before, so each
    is computed once however often the next step looks at it.
    """
    stepped = reduce(lambda array, step: f"transform({array}, w -> {step})", STEPS, words)
    kept = f"octet_length(word) NOT BETWEEN {MIN_BYTES} AND {MAX_BYTES}"
    return F.expr(f"zip_with({words}, {stepped}, (word, stem) -> CASE WHEN {kept} THEN word ELSE stem END)")
