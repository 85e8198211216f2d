"""Arithmetic of the scoring model as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the model: probability of an unseen level, bits of weight that count, bounds of concentration ratios.
UNSEEN, WEIGHT_BITS, CONCENTRATION = 1e-4, 60.0, (1.0, 50.0)


def clip(c: Column, low, high) -> Column:
    return F.greatest(F.least(c, F.lit(high)), F.lit(low))


def bits(m: Column, u: Column) -> Column:
    """log2 of a likelihood ratio; levels that were never seen count as rare, so no logarithm of 0 comes up."""
    return F.log2(F.greatest(F.coalesce(m, F.lit(UNSEEN)), F.lit(UNSEEN)) / F.greatest(F.coalesce(u, F.lit(UNSEEN)), F.lit(UNSEEN)))


def odds(weight: Column) -> Column:
    return F.pow(F.lit(2.0), clip(weight, -WEIGHT_BITS, WEIGHT_BITS))


def share_among(own: Column, sum_a: Column, sum_b: Column) -> Column:
    """Probability of a pair against its competitors on both sides."""
    return own / (1 + sum_a + sum_b - own)


def concentration(others: Column, expected: Column) -> Column:
    return clip((others + 1) / (expected + 1), *CONCENTRATION)


def ratio(a: Column, b: Column, floor: float) -> Column:
    return a / F.greatest(b, F.lit(floor))


def jaccard(a: Column, b: Column) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union)


def proper_subset(a: Column, b: Column) -> Column:
    return (F.size(F.array_except(a, b)) == 0) & (F.size(a) < F.size(b))


def md5_key(*cols, seed: str = "") -> Column:
    """Reproducible random order: hash of a seed and a key."""
    return F.md5(F.concat_ws("|", F.lit(seed), *(F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in cols)))


def draw(n: Column, *cols, seed: str = "") -> Column:
    """Reproducible whole number from 0 to n - 1 for a row: 28 bits of the hash."""
    return F.conv(F.substring(md5_key(*cols, seed=seed), 1, 7), 16, 10).cast("long") % n
