"""Wall-clock differences and calendar helpers."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from .ids import _col


def moment(as_of: date | datetime) -> Column:
    """A zone-less timestamp literal, independent of the driver's own time zone."""
    return F.lit(as_of.isoformat()).cast("timestamp_ntz")


def hours_between(later: Column | str, earlier: Column | str, mode: str = "elapsed") -> Column:
    """Hours from ``earlier`` to ``later``.

    ``elapsed`` counts full hours; ``boundary`` counts the full hours of the clock that
    were crossed (10:59 to 12:01 is 1 elapsed and 2 boundaries).
    """
    a, b = _col(later), _col(earlier)
    if mode == "boundary":
        return (F.datediff(a, b) * 24 + F.hour(a) - F.hour(b)).cast("bigint")
    if mode != "elapsed":
        raise ValueError(f"unknown mode {mode!r}")
    gap = a - b
    return (F.extract(F.lit("DAY"), gap) * 24 + F.extract(F.lit("HOUR"), gap)).cast("bigint")


def days_between(later: Column | str, earlier: Column | str) -> Column:
    """Difference of the calendar dates."""
    return F.datediff(F.to_date(_col(later)), F.to_date(_col(earlier))).cast("bigint")


def to_zone(col: Column | str, zone: str) -> Column:
    """UTC wall clock to the wall clock of ``zone``."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), _col(col))


def month_start(col: Column | str) -> Column:
    return F.trunc(_col(col), "MM")


def days_in_month(col: Column | str) -> Column:
    return F.dayofmonth(F.last_day(_col(col))).cast("bigint")


def days_of_month(col: Column | str) -> Column:
    """Array with every date of the month of ``col``."""
    return F.sequence(month_start(col), F.last_day(_col(col)), F.expr("interval 1 day"))
