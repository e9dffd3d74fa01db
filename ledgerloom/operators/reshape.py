"""Row-multiplying and reshaping operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timing import days_in_month, days_of_month
from .joins import lookup


def spread_month(df: DataFrame, date: str, measures: Sequence[str], out: str = "order_date") -> DataFrame:
    """One monthly row becomes one row per calendar day, each measure divided by the days.

    Sum to months before calling this: the explode multiplies rows by up to 31.
    """
    days = days_in_month(date).cast("double")
    shares = {m: F.col(m).cast("double") / days for m in measures}
    kept = [c for c in df.columns if c != out]
    return df.withColumns(shares).select(*kept, F.explode(days_of_month(date)).alias(out))


def unpivot_pairs(
    df: DataFrame,
    ids: Sequence[str],
    pairs: Mapping[str, Sequence[str]],
    names: Sequence[str],
    label: str = "month",
) -> DataFrame:
    """Groups of columns become rows: label -> columns, read into ``names``.

    A row is dropped only if all its values are NULL.
    """
    rows = F.array(
        *[
            F.struct(
                F.lit(key).alias(label),
                *[F.col(c).cast("double").alias(n) for c, n in zip(cols, names)],
            )
            for key, cols in pairs.items()
        ]
    )
    any_value = reduce(lambda a, b: a | b, [F.col(n).isNotNull() for n in names])
    long = df.select(*ids, F.explode(rows).alias("_r"))
    return long.select(*ids, f"_r.{label}", *[f"_r.{n}" for n in names]).where(any_value)


def cutover_union(old: DataFrame, new: DataFrame, cutover, date: str = "order_date") -> DataFrame:
    """The old layout as it is, the new one only from ``cutover`` on."""
    return old.unionByName(new.where(F.col(date) >= F.lit(cutover)))


def exclude_groups(df: DataFrame, key: str, predicate: Column) -> DataFrame:
    """Rows of those groups in which ``predicate`` holds for at least one row.

    A semi join on the qualifying keys: a window would hold each group in one task.
    """
    # NULL is a group too: it is told apart by a flag and a stand-in value
    group = F.coalesce(F.col(key).cast("string"), F.lit("")).alias("_key")
    flag = F.col(key).isNull().alias("_null")
    keys = df.where(predicate).select(group, flag).distinct()
    rows = df.select("*", group, flag)
    return lookup(rows, keys, ["_key", "_null"], "left_semi").drop("_key", "_null")
