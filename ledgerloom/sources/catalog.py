"""Named result tables in the session catalog, partitioned by day, and an insert-only append in two steps.

Tables are parquet, external, at ``<warehouse>/<name>``: a driver that restarts with an empty catalog
registers them again from their folder (:func:`open_table`).  A partitioned table is written by day;
replacing some days rewrites only those partition folders (dynamic partition overwrite).

The append of new rows (:func:`staged_append`) is a staged commit that a job can repeat at any point:

1. *stage*: the run (named by the caller, the same in every attempt) fixes its high-water mark once, from
   the table's partition list (no scan of the data), records it in the run's log, and writes the new
   rows to the run's staging folder in the shared folder;
2. *commit*: the staged rows replace exactly the days they hold, which all lie above the mark, and the
   log records the commit.

An attempt broken off anywhere is repeated from the recorded mark: staging is rewritten with the same
rows, and replacing the same days with the same rows changes nothing else.  A run whose commit is
recorded does nothing.  One writer per table at a time; runs must follow one another.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedupe import dedupe_first, dedupe_latest
from ..session import stable_folder
from .tables import read_table

STAGED, COMMITTED = "staged", "committed"
# A task of a build or an append sorts what it reads, up to this much of a file or this share of a shuffle
# (adaptive execution puts small shares together again).  200 is the most that Spark writes without a sort.
SPLIT, SHARES = 32 << 20, 200


@contextmanager
def _conf(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Session settings for the time of a write."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def _small_tasks(spark: SparkSession):
    """Tasks whose memory does not follow the size of the table."""
    shares = max(SHARES, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return _conf(
        spark,
        {"spark.sql.files.maxPartitionBytes": f"{SPLIT}b", "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shares)},
    )


def location(spark: SparkSession, name: str) -> str:
    """The folder of table ``name`` below the session's warehouse."""
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    return f"{warehouse.rstrip('/')}/{name}"


def open_table(spark: SparkSession, name: str) -> bool:
    """Whether table ``name`` exists; a folder without a catalog entry is registered with its days."""
    if spark.catalog.tableExists(name):
        return True
    path = location(spark, name)
    if read_table(spark, path) is None:
        return False
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return True


def write_table(df: DataFrame, name: str, partition_by: str | None = None) -> None:
    """Replace table ``name`` by ``df`` (created if missing), partitioned by ``partition_by``."""
    spark = df.sparkSession
    with _small_tasks(spark):
        writer = _by_day(df, partition_by).write.mode("overwrite").format("parquet").option("path", location(spark, name))
        if partition_by is not None:
            writer = writer.partitionBy(partition_by)
        if spark.catalog.tableExists(name):
            spark.sql(f"DROP TABLE {name}")  # external: the folder stays and is overwritten below
        writer.saveAsTable(name)


def _by_day(df: DataFrame, day: str | None) -> DataFrame:
    """Rows ranged by day and a hash of the row: a task writes a run of days, a hot day spans several tasks."""
    if day is None:
        return df
    return df.repartitionByRange(F.col(f"`{day}`"), F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))


def replace_partitions(df: DataFrame, name: str) -> None:
    """Rewrite the partitions of table ``name`` that ``df`` has rows for; other partitions stay."""
    spark = df.sparkSession
    columns = spark.table(name).columns
    with _small_tasks(spark), _conf(spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
        parts = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
        _by_day(df.select(*[F.col(f"`{c}`") for c in columns]), parts[0] if parts else None).write.insertInto(name, overwrite=True)


def latest_partition(spark: SparkSession, name: str, column: str):
    """The greatest value of partition column ``column`` from the table's partition list, or None.

    Read from the catalog: no data file is opened.  The NULL partition does not count.
    """
    kind = spark.table(name).schema[column].dataType
    listed = spark.sql(f"SHOW PARTITIONS {name}")
    value = F.regexp_extract("partition", f"(?:^|/){column}=([^/]*)", 1)
    value = F.when(value != "__HIVE_DEFAULT_PARTITION__", F.url_decode(value))
    return listed.agg(F.max(value.cast(kind))).first()[0]


def fresh_rows(
    src: DataFrame, mark, keys: Sequence[str], date_col: str, version: str, tiebreak: Sequence[Column | str] = ()
) -> DataFrame:
    """Newest version of each key of the source rows dated after ``mark``; with no mark, of all rows."""
    rows = src if mark is None else src.where(F.col(date_col) > F.lit(mark))
    newest = dedupe_latest(rows, keys, version, tiebreak).drop(version)
    # one row per key is distinct already, unless a key is dropped with the version
    return newest.distinct() if version.lower() in {k.lower() for k in keys} else newest


def first_build(
    src: DataFrame, name: str, keys: Sequence[str], date_col: str, version: str, tiebreak: Sequence[Column | str] = ()
) -> None:
    """Table ``name`` built from the lowest version of each key, partitioned by ``date_col``."""
    write_table(dedupe_first(src, keys, version, tiebreak).drop(version), name, date_col)


def _log(spark: SparkSession, stage: str, state: str):
    return read_table(spark, f"{stage}/{state}")


def staged_append(
    src: DataFrame,
    name: str,
    run_id: str,
    keys: Sequence[str],
    date_col: str,
    version: str,
    tiebreak: Sequence[Column | str] = (),
    floor=None,
    commit: bool = True,
) -> str:
    """Append the rows of ``src`` dated after the table's last day, as run ``run_id``; returns the state.

    The mark is the table's greatest ``date_col`` partition; on a missing or empty table it is ``floor``
    (None: every row, undated ones too, which go to the NULL partition).  Later runs never take undated
    rows, as no mark is below them.  ``commit=False`` stops after staging (a job broken off there).
    Returns ``"committed"``, ``"staged"`` or ``"unchanged"`` (the run was committed before).
    """
    spark = src.sparkSession
    stage = stable_folder(spark, "staging", name, run_id)
    if _log(spark, stage, COMMITTED) is not None:
        return "unchanged"
    logged = _log(spark, stage, STAGED)
    exists = open_table(spark, name)
    kind = src.schema[date_col].dataType
    if logged is not None:
        mark = logged.select(F.col("mark").cast(kind)).first()[0]
    else:
        mark = latest_partition(spark, name, date_col) if exists else None
        mark = floor if mark is None else mark
        spark.createDataFrame([(None if mark is None else str(mark),)], "mark string").write.mode("overwrite").parquet(f"{stage}/{STAGED}")
    with _small_tasks(spark):
        fresh_rows(src, mark, keys, date_col, version, tiebreak).write.mode("overwrite").parquet(f"{stage}/rows")
    if not commit:
        return STAGED
    staged = spark.read.parquet(f"{stage}/rows")
    if exists:
        replace_partitions(staged, name)
    else:
        write_table(staged, name, date_col)
    spark.createDataFrame([(COMMITTED,)], "state string").write.mode("overwrite").parquet(f"{stage}/{COMMITTED}")
    return COMMITTED
