"""Weighted draws as plain column expressions.

A draw is a number in [0, 1); the shares of the choices lie end to end on that
interval, and the draw falls into one of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column
from pyspark.sql import functions as F


def arithmetic_unif(key: Column, mult: int, modulus: int) -> Column:
    """Uniform-ish draw ``(key * mult mod modulus) / modulus`` that any SQL
    engine reproduces exactly."""
    return F.pmod(key.cast("long") * F.lit(mult), F.lit(modulus)).cast("double") / F.lit(float(modulus))


def hash_unif(*keys: Column, salt: int = 0) -> Column:
    """A draw that depends on the keys and the salt only: the same on every run, executor and retry."""
    return F.pmod(F.xxhash64(*keys, F.lit(salt)), F.lit(1 << 53)).cast("double") / F.lit(float(1 << 53))


def entity_code(number: Column, prefix: str = "871", digits: int = 15) -> Column:
    """An entity key in the format of the range table: a prefix and the number, filled with zeros."""
    return F.concat(F.lit(prefix), F.lpad(number.cast("string"), digits, "0"))


def share_index(draw: Column, shares: Sequence[float]) -> Column:
    """0-based index of the share that ``draw`` falls into; ``shares`` sum to 1."""
    if not shares or abs(sum(shares) - 1) > 1e-9:
        raise ValueError("shares must sum to 1")
    ends = F.array(*[F.lit(round(e, 9)) for e in accumulate(shares)][:-1])
    return F.size(F.filter(ends, lambda end: end <= draw))


def weighted_pick(draw: Column, choices: Sequence, shares: Sequence[float]) -> Column:
    """The choice whose share ``draw`` falls into."""
    if len(choices) != len(shares):
        raise ValueError("choices and shares must be of equal length")
    return F.get(F.array(*[F.lit(c) for c in choices]), share_index(draw, shares))


def bucketed_length(bucket_draw: Column, within_draw: Column, buckets: Sequence[tuple[float, int, int]]) -> Column:
    """A whole number from the bucket ``(share, lowest, end)`` that ``bucket_draw``
    falls into, placed inside it by ``within_draw``; ``end`` is excluded."""
    bounds = F.array(*[F.struct(F.lit(lo).alias("lo"), F.lit(end - lo).alias("width")) for _, lo, end in buckets])
    b = F.get(bounds, share_index(bucket_draw, [share for share, _, _ in buckets]))
    return (b["lo"] + F.floor(within_draw * b["width"])).cast("int")
