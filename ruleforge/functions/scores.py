"""Numbers of the evolution: fitness, weights, sizes, depths; distances of vectors and hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fitness(used: Column, depth: Column, mutated: Column, noise: Column) -> Column:
    """Rarely used and deep rules rank higher; ``noise`` is uniform in [0, 1). Mutated ones gain a tenth."""
    fresh = F.lit(0.4) / (1 + F.lit(0.2) * used)
    deep = F.lit(0.4) * F.least(F.lit(1.0), F.lit(0.5) + F.lit(0.1) * depth)
    return (fresh + deep + F.lit(0.2) * (F.lit(0.8) + F.lit(0.4) * noise)) * F.when(mutated, 1.1).otherwise(1.0)


def parent_weight(used: Column) -> Column:
    return F.lit(1.0) / (used + 1)


def elite_count(n: Column, share: float = 0.1) -> Column:
    return F.greatest(F.lit(1), F.floor(n * F.lit(share)).cast("int"))


def target_size(n: Column, growth: float = 1.2) -> Column:
    return F.floor(n * F.lit(growth)).cast("int")


def offspring_count(n: Column, growth: float = 1.2, share: float = 0.1) -> Column:
    return F.greatest(F.lit(0), target_size(n, growth) - elite_count(n, share))


def child_depth(a: Column, b: Column) -> Column:
    return F.greatest(F.coalesce(a, F.lit(0)), F.coalesce(b, F.lit(0))) + 1


def backoff(attempt: Column, base: float = 1.0, factor: float = 2.0, most: float = 300.0) -> Column:
    """Seconds to wait after the failed call number ``attempt``, counted from 0."""
    return F.least(F.lit(most), F.lit(base) * F.pow(F.lit(factor), attempt))


def squared_distance(a: Column, b: Column) -> Column:
    """Squared Euclidean distance in double precision."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.pow(x.cast("double") - y.cast("double"), 2)), F.lit(0.0), lambda s, x: s + x)


def hamming(a: Column, b: Column) -> Column:
    """Different bits of two hashes held as arrays of longs."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)


def sign_bits(v: Column) -> Column:
    """One long with bit i set where component i of up to 64 is positive."""
    return F.aggregate(F.transform(v, lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long"))), F.lit(0).cast("long"), lambda s, x: s.bitwiseOR(x))
