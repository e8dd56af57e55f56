"""Filters of stored keys, so that an append looks only where one of its keys may be stored.

A filter is a Bloom filter in words of 64 bits, as rows ``(word, bits)``: a key sets four bits of one word, and words
are merged by ``bit_or``. It takes about two bytes a key on disk, is built by one aggregate and asked by one join, so
it never passes through the driver however many keys there are. A key that is stored is always found.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits for each key: about one key in a hundred that is not stored seems to be.
BITS_PER_KEY = 16
SEED = 97


def words_for(n_keys: int) -> int:
    return max(1, -(-n_keys * BITS_PER_KEY // 64))


def _word(key: str, words: int | Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(SEED), key), words if isinstance(words, Column) else F.lit(words))


def _bits(key: str) -> Column:
    """A word with the key's four bits, each from six bits of a second hash."""
    one = F.xxhash64(F.lit(SEED + 1), key)
    places = [F.shiftrightunsigned(one, 6 * k).bitwiseAND(F.lit(63)).cast("int") for k in range(4)]
    return reduce(Column.bitwiseOR, (F.call_function("shiftleft", F.lit(1).cast("bigint"), place) for place in places))


def key_filter(keys: DataFrame, key: str, words: int) -> DataFrame:
    """``word, bits`` of the filter of all ``keys``, sorted by word; null keys are in no filter."""
    bits = keys.filter(F.col(key).isNotNull()).select(_word(key, words).alias("word"), _bits(key).alias("bits"))
    return bits.groupBy("word").agg(F.bit_or("bits").alias("bits"))


def may_be_stored(incoming: DataFrame, key: str, stored_filter: DataFrame, words: int) -> DataFrame:
    """The keys of ``incoming`` that the filter does not rule out."""
    asked = incoming.select(key, _word(key, words).alias("word"), _bits(key).alias("asked"))
    met = asked.join(stored_filter, "word").filter(F.col("bits").bitwiseAND(F.col("asked")) == F.col("asked"))
    return met.select(key)
