"""A folder of CSV files with differing headers."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.timing import moment

# Fixed values.
PATTERNS = ["email", "sms", "push", "wtsp", "whatsapp"]
ROUTES = {"email": ["email"], "sms": ["sms"], "push": ["push"], "whatsapp": ["wtsp", "whatsapp"]}
EXCLUDE_PATTERN = r"excl(ude)?d?\s?\w*|exl(ude)?\s?\w*"
HEADER_MARKS = ["-", "__", "/", ",", "(", ")"]
GAP_WORDS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
FILE_COLUMN = "_file"


def csv_files(
    spark: SparkSession, path: str, patterns: Sequence[str] = PATTERNS
) -> dict[tuple[str, str], list[str]]:
    """(channel, name) -> CSV files, for the entries of a folder whose name has a pattern.

    An entry is a file, or the directory of part files that Spark writes under a file's
    name.  Only names are read, and only names reach the driver.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.[cC][sS][vV]")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path")
    )
    below = F.element_at(F.split("path", re.escape(path.rstrip("/") + "/")), -1)
    name = F.lower(F.element_at(F.split(below, "/"), 1))
    wanted = reduce(lambda a, b: a | b, [F.contains(name, F.lit(p)) for p in patterns])
    entries: dict[tuple[str, str], list[str]] = defaultdict(list)
    named = files.select(name.alias("name"), "path").where(wanted)
    for r in named.withColumn("channel", route_channel("name")).sort("path").collect():
        entries[r.channel, r.name].append(r.path)
    return entries


def normalise_headers(names: Sequence[str]) -> list[str]:
    """Lower case, blanks to ``_``, then each mark to ``_`` in order, once.

    Raises if two headers become the same.
    """
    out = []
    for name in names:
        name = re.sub(r"\s+", "_", name.lower().strip())
        for mark in HEADER_MARKS:
            name = name.replace(mark, "_")
        out.append(name)
    if len(set(out)) != len(out):
        raise ValueError(f"headers collide after normalising: {sorted(out)}")
    return out


def csv_folder_scan(
    spark: SparkSession, path: str, patterns: Sequence[str] = PATTERNS
) -> list[tuple[str, DataFrame]]:
    """(channel, frame of text columns) per channel and distinct header.

    The header of each file is its own first row, read as the rows are; files without one are
    skipped.  Files with the same header are read together.  Cells may hold line breaks in
    quotes, so one file is one task.
    """
    def reader():
        return spark.read.option("header", "true").option("escape", '"').option("multiLine", "true")

    groups: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for (channel, _), files in csv_files(spark, path, patterns).items():
        for file in files:
            header = reader().csv(file).columns
            if header:
                groups[(channel, *header)].append(file)
    frames = []
    for (channel, *header), files in groups.items():
        schema = StructType([StructField(n, StringType()) for n in normalise_headers(header)])
        rows = reader().schema(schema).csv(files)
        frames.append((channel, rows.withColumn(FILE_COLUMN, F.col("_metadata.file_path"))))
    return frames


def route_channel(file_name: Column | str) -> Column:
    """Campaign channel from a file name, first match wins."""
    name = F.lower(file_name)
    out = None
    for channel, words in ROUTES.items():
        hit = reduce(lambda a, b: a | b, [F.contains(name, F.lit(w)) for w in words])
        out = F.when(hit, channel) if out is None else out.when(hit, channel)
    return out


def scrub_cells(
    df: DataFrame, pattern: str = EXCLUDE_PATTERN, skip: Sequence[str] = (FILE_COLUMN,)
) -> DataFrame:
    """A cell that contains the pattern, is blank or is a gap becomes ``0``.

    The pattern is case-sensitive and replaces the whole cell.
    """
    fixed = {}
    for field in df.schema:
        if field.name in skip:
            continue
        cell = F.col(f"`{field.name}`")
        if isinstance(field.dataType, StringType):
            bad = cell.isNull() | cell.rlike(pattern) | cell.rlike(r"^\s*$") | cell.isin(*GAP_WORDS)
            fixed[field.name] = F.when(bad, "0").otherwise(cell)
        else:
            fixed[field.name] = F.coalesce(cell, F.lit(0).cast(field.dataType))
    return df.select(*[fixed.get(c, F.col(f"`{c}`")).alias(c) for c in df.columns])


def concat_by_name(dfs: Sequence[DataFrame], drop_first: bool = True) -> DataFrame:
    """Union by name with NULL for absent columns; the first column goes if there are more."""
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
    return out.drop(out.columns[0]) if drop_first and len(out.columns) > 1 else out


def campaign_frames(
    spark: SparkSession, path: str, as_of: datetime, patterns: Sequence[str] = PATTERNS
) -> dict[str, DataFrame]:
    """Cleaned campaign rows per channel."""
    per_channel: dict[str, list[DataFrame]] = defaultdict(list)
    for channel, frame in csv_folder_scan(spark, path, patterns):
        clean = scrub_cells(frame).drop(FILE_COLUMN)
        per_channel[channel].append(clean.withColumn("pg_extracted_at", moment(as_of)))
    return {channel: concat_by_name(frames) for channel, frames in per_channel.items()}
