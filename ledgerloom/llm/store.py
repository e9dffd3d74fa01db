"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import shared_folder, tune


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the library's settings and Arrow batches that stay small for long texts."""
    tune(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    return spark


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table written to the shared folder and read back: cuts the lineage, keeps one copy."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def partitions(df: DataFrame) -> int:
    """The session's number of shuffle partitions, which follows the size of the data."""
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
