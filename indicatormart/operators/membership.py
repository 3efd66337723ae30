"""Bitmaps of hashed keys: which rows may match, before an exact join of those only.

A bitmap has a chosen number of bits, whatever the data: a table of at most
``MAX_BITS / 64`` rows ``(word, bits)``, so it may be broadcast.  A key that is
in it is always found; another one is taken for one of it with about
1 / ``BITS_PER_KEY`` (more once the cap holds).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY = 16
#: 262,144 words at most: a few MB in a broadcast.
MAX_BITS = 1 << 24


def bits_for(n_keys: int) -> int:
    """A power of two with ``BITS_PER_KEY`` bits a key, capped."""
    return min(MAX_BITS, 1 << max(10, (BITS_PER_KEY * max(1, n_keys) - 1).bit_length()))


def worthwhile(n_keys: int) -> bool:
    """Whether a capped bitmap still tells keys apart."""
    return 2 * n_keys <= MAX_BITS


def bitmap(keys: DataFrame, hash_col: str, bits: int) -> DataFrame:
    """``(word, bits)`` of the 64-bit hashes in ``hash_col``: one hash aggregate over two longs."""
    slot = f"pmod(`{hash_col}`, {bits}L)"
    return keys.select(F.expr(f"shiftright({slot}, 6)").alias("__word"),
                       F.expr(f"shiftleft(1L, cast({slot} % 64 AS INT))").alias("__bit")) \
        .groupBy("__word").agg(F.bit_or("__bit").alias("__bits"))


def maybe_in(df: DataFrame, hash_col: str, words: DataFrame, bits: int, out: str) -> DataFrame:
    """``df`` with a flag ``out``: false only where the hash is not in the bitmap."""
    slot = f"pmod(`{hash_col}`, {bits}L)"
    joined = df.join(F.broadcast(words), F.expr(f"shiftright({slot}, 6)") == F.col("__word"), "left")
    hit = F.expr(f"shiftright(__bits, cast({slot} % 64 AS INT)) & 1L") == 1
    return joined.withColumn(out, F.coalesce(hit, F.lit(False))).drop("__word", "__bits")
