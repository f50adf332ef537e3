"""A seeded permutation of 0 .. n-1 without a sort (PR-18).

A Feistel network over the grid a x b, a = ceil(sqrt(n)), b = ceil(n / a): a
place is a pair (l, r), and each round adds a function of one half to the
other, which can be undone, so the network is one-to-one. Places of the grid
beyond n - 1 are walked on: the network is applied again until a place below n
comes out, which keeps it one-to-one on 0 .. n-1. Fewer than a places are
beyond, so a walk is rarely longer than one step.

Every row computes its place alone: a narrow projection, with no exchange.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.index import with_index

ROUNDS = 6
PRIME = 2**31 - 1
#: Steps after which a walk must have ended: certain up to 4,096 rows, where
#: fewer places than this are beyond; later a share of 1 / sqrt(n) a step.
WALK = 64


def round_keys(seed: int, rounds: int = ROUNDS) -> list[tuple[int, int]]:
    """Multiplier and offset of each round, from the seed."""
    keys = []
    for i in range(rounds):
        h = hashlib.md5(f"{seed}:{i}".encode()).digest()
        keys.append((int.from_bytes(h[:4], "little") % (PRIME - 2) + 1, int.from_bytes(h[4:8], "little") % PRIME))
    return keys


def grid(n: int) -> tuple[int, int]:
    a = max(math.isqrt(max(n - 1, 0)) + 1, 1)
    return a, max(-(-n // a), 1)


def _mixed(v: Column, key: Column) -> Column:
    t = (v * key["a"] + key["b"]) % PRIME
    return (t * t) % PRIME


def permuted(place: Column, n: int, seed: int = 55) -> Column:
    """Where the row at ``place`` (0 .. n-1) goes."""
    if n >= 2**60:
        raise ValueError("halves of a place must stay below 2**31")
    a, b = (F.lit(x).cast("long") for x in grid(n))
    keys = F.array(*[F.struct(F.lit(x).cast("long").alias("a"), F.lit(y).cast("long").alias("b"), F.lit(i % 2 == 0).alias("left"))
                     for i, (x, y) in enumerate(round_keys(seed))])

    def step(at: Column) -> Column:
        start = F.struct(F.call_function("div", at, b).alias("l"), (at % b).alias("r"))
        return F.aggregate(keys, start, lambda s, k: F.struct(
            F.when(k["left"], (s["l"] + _mixed(s["r"], k)) % a).otherwise(s["l"]).alias("l"),
            F.when(k["left"], s["r"]).otherwise((s["r"] + _mixed(s["l"], k)) % b).alias("r")), lambda s: s["l"] * b + s["r"])

    def walk(at: Column) -> Column:
        more = F.aggregate(F.sequence(F.lit(2), F.lit(WALK)), at, lambda x, _: F.when(x < n, x).otherwise(step(x)))
        return F.when(at < n, at).otherwise(more)

    return F.get(F.transform(F.array(step(place.cast("long"))), walk), 0)  # the first step is taken once


def permute(df: DataFrame, seed: int = 55, position: str = "position") -> DataFrame:
    """PR-18 for a stored table (the scan of a parquet table): adds each row's
    place in a permutation of the rows that depends on their storage order and
    the seed alone. Rows are counted from the files' footers; nothing is
    shuffled, sorted or written."""
    n = df.count()
    return with_index(df, name="_at").withColumn(position, permuted(F.col("_at"), n, seed)).drop("_at")
