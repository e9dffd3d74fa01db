"""Joins of a large table to a lookup that a hot key cannot slow down."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join on equal column names so that a hot key of ``left`` is split over tasks.

    Spark splits a skewed partition only if both sides of a sort-merge join come straight
    from a shuffle.  A lookup that was grouped or deduplicated on the key does not: it
    reuses the grouping's partitioning.  The hash of the key, as one more join column,
    changes no match and makes both sides shuffle for the join.  A lookup below Spark's
    broadcast threshold is still broadcast.
    """
    return lookups(left, [right], on, how)


def lookups(left: DataFrame, rights: Sequence[DataFrame], on: Sequence[str], how: str = "left") -> DataFrame:
    """:func:`lookup` of several frames on one key: ``left`` is shuffled once for all of them."""
    tag = F.hash(*on)
    out = left.withColumn("_hash", tag)
    for right in rights:
        kinds = {c: (left.schema[c].dataType, right.schema[c].dataType) for c in on}
        unlike = {c: k for c, k in kinds.items() if k[0] != k[1]}
        if unlike:
            raise TypeError(f"join columns differ in type: {unlike}")
        out = out.join(right.withColumn("_hash", tag), [*on, "_hash"], how)
    return out.drop("_hash")
