"""Seeded draws that every engine can repeat: MD5 numbers instead of an engine's own hash.

A number is the first 15 hexadecimal digits (60 bits) of an MD5. A permutation of
the positions ``0 .. n-1`` is a sequence of swap-or-not rounds: round ``r`` pairs
``x`` with ``(k_r - x) mod n`` and a bit of the pair's larger member decides whether
the two change places. Each row computes its own image, so nothing is sorted or moved.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGITS = 15
ROUNDS = 32


def number(text: Column) -> Column:
    """The MD5 number of a text (null: null)."""
    return F.conv(F.substring(F.md5(text), 1, DIGITS), 16, 10).cast("long")


def draw_key(value: Column, seed: int) -> Column:
    """The MD5 number of ``seed:value`` (a null value as an empty one)."""
    return number(F.concat(F.lit(f"{seed}:"), F.coalesce(value.cast("string"), F.lit(""))))


def round_keys(n: int, seed: int, rounds: int = ROUNDS) -> list[int]:
    return [int(hashlib.md5(f"{seed}:{r}".encode()).hexdigest()[:DIGITS], 16) % n for r in range(rounds)]


def permuted(position: Column, n: int, seed: int, rounds: int = ROUNDS) -> Column:
    """The image of ``position`` under the seeded permutation of ``0 .. n-1``."""
    size = F.lit(max(n, 1)).cast("long")
    steps = F.array(*[F.struct(F.lit(r).alias("r"), F.lit(k).cast("long").alias("k"))
                      for r, k in enumerate(round_keys(max(n, 1), seed, rounds))])

    def step(x: Column, s: Column) -> Column:
        other = F.pmod(s["k"] - x, size)
        pair = F.concat(F.lit(f"{seed}:"), s["r"].cast("string"), F.lit(":"), F.greatest(x, other).cast("string"))
        return F.when(number(pair) % 2 == 1, other).otherwise(x)

    return F.aggregate(steps, position.cast("long"), step)
