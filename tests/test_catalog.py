"""Named, day-partitioned tables and the staged append: repeats, break-offs, a lost catalog, plans."""

import uuid
from datetime import date

import pytest

from ledgerloom.sources import catalog as k

KEYS = ["key", "day"]
ROWS = "key int, day date, version int, amount int"


def name():
    return f"t_{uuid.uuid4().hex[:10]}"


@pytest.fixture
def feed(spark):
    rows = [
        (1, date(2024, 1, 1), 1, 10), (1, date(2024, 1, 1), 2, 11), (2, date(2024, 1, 2), 1, 20),
        (3, date(2024, 1, 3), 1, 30), (3, date(2024, 1, 3), 3, 33), (4, date(2024, 1, 4), 1, 40),
        (5, None, 1, 50), (6, date(1999, 12, 31), 1, 60),
    ]
    return spark.createDataFrame(rows, ROWS)


def content(spark, table):
    return sorted(tuple(r) for r in spark.table(table).select("key", "day", "amount").collect())


def test_break_off_after_staging_then_repeat(spark, feed):
    t = name()
    k.first_build(feed.where("day <= DATE'2024-01-02'"), t, KEYS, "day", "version")
    before = content(spark, t)
    assert k.staged_append(feed, t, "run-a", KEYS, "day", "version", commit=False) == "staged"
    assert content(spark, t) == before  # nothing committed yet
    assert k.staged_append(feed, t, "run-a", KEYS, "day", "version") == "committed"
    after = content(spark, t)
    assert after == sorted(before + [(3, date(2024, 1, 3), 33), (4, date(2024, 1, 4), 40)])
    assert k.staged_append(feed, t, "run-a", KEYS, "day", "version") == "unchanged"
    assert k.staged_append(feed, t, "run-b", KEYS, "day", "version") == "committed"
    assert content(spark, t) == after


def test_repeat_of_a_half_done_commit(spark, feed):
    """The staged rows of one day reached the table before the break: the repeat keeps its recorded mark."""
    t = name()
    k.first_build(feed.where("day <= DATE'2024-01-02'"), t, KEYS, "day", "version")
    k.staged_append(feed, t, "run-a", KEYS, "day", "version", commit=False)
    part = spark.read.parquet(k.stable_folder(spark, "staging", t, "run-a", "rows")).where("day = DATE'2024-01-04'")
    k.replace_partitions(part, t)  # half of the commit
    assert k.staged_append(feed, t, "run-a", KEYS, "day", "version") == "committed"
    assert (3, date(2024, 1, 3), 33) in content(spark, t)  # not lost below the half-committed day


def test_empty_table_takes_every_row_or_the_floor(spark, feed):
    t = name()
    assert k.staged_append(feed, t, "r", KEYS, "day", "version") == "committed"
    got = content(spark, t)
    assert (5, None, 50) in got and (6, date(1999, 12, 31), 60) in got and len(got) == 6
    u = name()
    k.staged_append(feed, u, "r", KEYS, "day", "version", floor=date(2000, 1, 1))
    assert [r[0] for r in content(spark, u)] == [1, 2, 3, 4]


def test_lost_catalog_entry_is_registered_again(spark, feed):
    t = name()
    k.first_build(feed, t, KEYS, "day", "version")
    rows = content(spark, t)
    spark.sql(f"DROP TABLE {t}")  # external: the folder stays, as after a restart with an empty catalog
    assert k.open_table(spark, t)
    assert content(spark, t) == rows
    assert k.latest_partition(spark, t, "day") == date(2024, 1, 4)


def test_mark_from_partitions_and_day_filters_in_the_scan(spark, feed):
    t = name()
    k.first_build(feed, t, KEYS, "day", "version")
    assert k.latest_partition(spark, t, "day") == date(2024, 1, 4)
    plan = spark.table(t).where("day > DATE'2024-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "day" not in plan.split("ReadSchema:")[1]
    listing = spark.sql(f"SHOW PARTITIONS {t}")._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in listing


def test_replace_keeps_other_days_and_write_replaces_all(spark, feed):
    t = name()
    k.first_build(feed, t, KEYS, "day", "version")
    k.replace_partitions(spark.createDataFrame([(9, date(2024, 1, 1), 90)], "key int, day date, amount int"), t)
    got = content(spark, t)
    assert (9, date(2024, 1, 1), 90) in got and (1, date(2024, 1, 1), 10) not in got and (2, date(2024, 1, 2), 20) in got
    k.write_table(spark.createDataFrame([(1, "x")], "a int, b string"), t)
    assert [tuple(r) for r in spark.table(t).collect()] == [(1, "x")]
