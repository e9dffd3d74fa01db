"""Actual orders against a forecast, per place and day."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import money_avg, money_sum

# Places of the report, day and number formats.
PLACES = ["mumbai", "bangalore", "kolkata", "bilaspur", "hyderabad"]
DAY_FORMAT = "dd MMM yyyy"
ROWS = 31
RECENT_DAYS = 7


def daily_wide_sum(
    df: DataFrame, channel: str, as_of: date, places: Sequence[str] = PLACES, limit: int = ROWS
) -> DataFrame:
    """Actual and projected sums per place for the days of the current month, newest first."""
    start = as_of.replace(day=1)
    end = (start + timedelta(days=32)).replace(day=1)
    month = df.where(
        (F.col("channel_name") == channel)
        & (F.col("order_date") >= F.lit(start))
        & (F.col("order_date") < F.lit(end))
    )
    sums = [
        money_sum(f"{p}_{kind}").alias(f"{p}_{kind}") for kind in ("actual", "projected") for p in places
    ]
    return month.groupBy("order_date").agg(*sums).orderBy(F.desc("order_date")).limit(limit)


def by_place(df: DataFrame, places: Sequence[str] = PLACES) -> DataFrame:
    """Wide day rows to one row per day and place."""
    rows = F.array(
        *[
            F.struct(
                F.lit(p).alias("place"),
                F.col(f"{p}_actual").alias("actual"),
                F.col(f"{p}_projected").alias("projected"),
            )
            for p in places
        ]
    )
    return df.select("order_date", F.explode(rows).alias("_r")).select("order_date", "_r.*")


def variance_band(col: Column | str, low: float = 0, high: float = 20) -> Column:
    """``low`` below the first bound, ``high`` above the second, else nothing."""
    col = F.col(col) if isinstance(col, str) else col
    return F.when(col < low, "low").when(col > high, "high")


def variance(df: DataFrame, places: Sequence[str] = PLACES) -> DataFrame:
    """Difference and percentage per day and place, as numbers and as report text.

    A gap becomes empty text; a percentage of a zero forecast is a gap.
    """
    gap = F.col("actual") - F.col("projected")
    exact = F.try_divide(gap * 100, F.col("projected"))
    pct = F.bround(exact.cast("decimal(18,6)"), 1).cast("double")
    long = by_place(df, places).withColumns({"a_p": gap, "a_p_pct": pct})
    # the report writes a small negative percentage as -0.0%
    minus_zero = F.when((F.col("a_p_pct") == 0) & (exact < 0), "-").otherwise("")

    def text(c: str) -> Column:
        return F.coalesce(F.format_number(c, 0), F.lit(""))

    return long.withColumns(
        {
            "date_text": F.date_format("order_date", DAY_FORMAT),
            "actual_text": text("actual"),
            "projected_text": text("projected"),
            "a_p_text": text("a_p"),
            "a_p_pct_text": F.coalesce(
                F.concat(minus_zero, F.col("a_p_pct").cast("decimal(18,1)").cast("string"), F.lit("%")),
                F.lit(""),
            ),
            "band": variance_band("a_p_pct"),
        }
    )


def forecast_accuracy(
    df: DataFrame, n: int = RECENT_DAYS, places: Sequence[str] = PLACES
) -> DataFrame:
    """Accuracy in percent of the mean forecast over the last ``n`` days with data.

    0 where the mean forecast is not positive.
    """
    days = df.select("order_date").distinct().orderBy(F.desc("order_date")).limit(n)
    means = (
        by_place(df.join(days, "order_date", "left_semi"), places)
        .groupBy("place")
        .agg(money_avg("actual").alias("actual_mean"), money_avg("projected").alias("projected_mean"))
    )
    a, p = F.col("actual_mean"), F.col("projected_mean")
    accuracy = F.when(p > 0, (1 - F.abs(a - p) / p) * 100).otherwise(0.0)
    return means.withColumn("accuracy", accuracy)
