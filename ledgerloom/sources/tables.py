"""Result tables: replaced whole, appended above a high-water mark, or grown by columns."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.dedupe import dedupe_first, dedupe_latest

EPOCH = date(2000, 1, 1)


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame | None:
    """The table at ``path`` with the columns of all its files, or None if there is none."""
    try:
        reader = spark.read.option("mergeSchema", "true")
        return (reader.schema(schema) if schema is not None else reader).parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def table_replace(df: DataFrame, path: str) -> None:
    """Write ``df`` as the whole content of ``path``."""
    df.write.mode("overwrite").parquet(path)


def first_build(
    src: DataFrame, path: str, keys: Sequence[str], version: str, tiebreak: Sequence[Column | str] = ()
) -> None:
    """Full build: the lowest version of each key, without the version column."""
    table_replace(dedupe_first(src, keys, version, tiebreak).drop(version), path)


def new_rows(
    src: DataFrame,
    target: DataFrame | None,
    keys: Sequence[str],
    date_col: str,
    version: str,
    tiebreak: Sequence[Column | str] = (),
) -> DataFrame:
    """Newest version of the source rows dated after everything in ``target``.

    The mark is one value, read first, so it reaches the source scan as a literal.  A row
    dated on or before it is not taken.
    """
    mark = target.agg(F.max(date_col)).first()[0] if target is not None else None
    fresh = src.where(F.col(date_col) > F.lit(EPOCH if mark is None else mark))
    return dedupe_latest(fresh, keys, version, tiebreak).drop(version).distinct()


def incremental_append(
    src: DataFrame,
    path: str,
    keys: Sequence[str],
    date_col: str,
    version: str,
    tiebreak: Sequence[Column | str] = (),
) -> None:
    """Append :func:`new_rows` to ``path``.

    One writer at a time: two that read the same mark would both append.
    """
    target = read_table(src.sparkSession, path)
    new_rows(src, target, keys, date_col, version, tiebreak).write.mode("append").parquet(path)


def append_evolve(df: DataFrame, path: str) -> None:
    """Append; columns the table lacks are added, and read as NULL in older rows."""
    df.write.mode("append").parquet(path)


def align_schema(df: DataFrame, target: StructType | Sequence[str]) -> DataFrame:
    """Columns of ``target`` in its order: missing ones NULL, others dropped."""
    if isinstance(target, StructType):
        wanted = {f.name: f.dataType for f in target}
    else:
        wanted = {name: "string" for name in target}
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f"`{c}`") if c in present else F.lit(None)).cast(kind).alias(c)
            for c, kind in wanted.items()
        ]
    )


def append_text(df: DataFrame, path: str) -> bool:
    """Append all columns as text in the layout of the table; an empty frame is skipped."""
    if df.isEmpty():
        return False
    text = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
    target = read_table(df.sparkSession, path)
    if target is not None:
        text = align_schema(text, target.columns)
    text.write.mode("append").parquet(path)
    return True
