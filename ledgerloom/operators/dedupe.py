"""One row per key.

All four use ``row_number() = 1``.  Spark keeps one row per key and map task before the
shuffle (WindowGroupLimit), so a hot key reaches its reducer as one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Keys = Sequence[Column | str]


def _first_row(df: DataFrame, keys: Keys, ordering: Keys) -> DataFrame:
    if not ordering:
        raise ValueError("a total order is required")
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*ordering))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def dedupe_latest(df: DataFrame, keys: Keys, order_by: str, tiebreak: Keys = ()) -> DataFrame:
    """Newest row per key; NULL order values come last."""
    return _first_row(df, keys, [F.desc(order_by), *tiebreak])


def dedupe_first(df: DataFrame, keys: Keys, order_by: str, tiebreak: Keys = ()) -> DataFrame:
    """Oldest row per key; NULL order values come first."""
    return _first_row(df, keys, [F.asc(order_by), *tiebreak])


def dedupe_any(df: DataFrame, keys: Keys, tiebreak: Keys) -> DataFrame:
    """One row per key; ``tiebreak`` makes the choice repeatable."""
    return _first_row(df, keys, tiebreak)


def pick_preferred(df: DataFrame, keys: Keys, preference: Column, tiebreak: Keys) -> DataFrame:
    """One row per key, a row for which ``preference`` is true if there is one."""
    return _first_row(df, keys, [F.when(preference, 0).otherwise(1), *tiebreak])
