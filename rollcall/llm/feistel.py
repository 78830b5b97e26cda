"""A keyed permutation of 0..n-1 as a Column: a Feistel network with cycle walking."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

ROUNDS = 6
MOST_STEPS = 64


def _halves(n: int) -> tuple[int, int]:
    """Moduli of the two halves; their product is the smallest near-square domain that holds n."""
    left = max(1, math.isqrt(max(n - 1, 0)) + 1)
    return left, max(1, -(-n // left))


def _round_value(key: str, round_no: Column, half: Column, modulus: int) -> Column:
    digest = F.sha2(F.concat_ws(":", F.lit(key), round_no.cast("string"), half.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("bigint") % modulus


def _network(value: Column, key: str, left: int, right: int) -> Column:
    """Odd rounds shift the left half by a digest of the right one, even rounds the other way."""
    start = F.struct(((value - value % right) / right).cast("bigint").alias("l"), (value % right).alias("r"))

    def turn(state: Column, round_no: Column) -> Column:
        l, r = state["l"], state["r"]
        odd = round_no % 2 == 1
        return F.struct(
            F.when(odd, (l + _round_value(key, round_no, r, left)) % left).otherwise(l).alias("l"),
            F.when(odd, r).otherwise((r + _round_value(key, round_no, l, right)) % right).alias("r"),
        )

    return F.aggregate(
        F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn, lambda s: s["l"] * right + s["r"]
    )


def permute(index: Column, n: int, key: str) -> Column:
    """The place of ``index`` in a permutation of 0..n-1 that ``key`` alone decides.

    The network permutes a domain of left x right values, fewer than n + sqrt(n) + 1.  A value
    that falls outside 0..n-1 is fed in again until it is inside.  A walk cannot be longer than
    the number of outside values; where that exceeds 64, one more step is needed with a chance
    below 1/64 each time, and a walk of over 64 steps raises an error instead of a wrong place.
    Null stays null.
    """
    left, right = _halves(n)
    value = index.cast("bigint")
    first = _network(value, key, left, right)
    outside = left * right - n
    if outside <= 0:
        return first
    steps = F.sequence(F.lit(1), F.lit(min(outside, MOST_STEPS)))
    walked = F.aggregate(
        steps,
        first,
        lambda acc, _: F.when(acc < n, acc).otherwise(_network(acc, key, left, right)),
        lambda acc: F.when(acc < n, acc).otherwise(F.raise_error(F.lit("cycle walk too long")).cast("bigint")),
    )
    return walked
