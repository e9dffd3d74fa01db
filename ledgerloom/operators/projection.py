"""Projection of missing days and allocation of targets.

A sales fact may hold several brands; every step works per (brand, channel), so one job
projects them all.  Averages are exact sums over counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import null_marker
from ..functions.numbers import FINE, money_avg, money_sum
from ..functions.timing import days_in_month, month_start
from .joins import lookup
from .sales import FACT_DIMS, MEASURES

SERIES = ["brand", "channel"]
ITEM = [c for c in FACT_DIMS if c != "order_date"]
LABELS = ["product_title", "master_title", "main_category", "sub_category"]
HORIZON = 60


def daily_agg(fact: DataFrame, dims: Sequence[str] = FACT_DIMS) -> DataFrame:
    """Sums per day and item."""
    return fact.groupBy(*dims).agg(*[money_sum(m).alias(m) for m in MEASURES])


def last_dates(daily: DataFrame, series: Sequence[str] = SERIES) -> DataFrame:
    """Last day with data per series."""
    return daily.groupBy(*series).agg(F.max("order_date").alias("max_date"))


def trailing_mean(
    daily: DataFrame,
    n: int = 7,
    series: Sequence[str] = SERIES,
    item: Sequence[str] = ITEM,
    measures: Sequence[str] = MEASURES,
) -> DataFrame:
    """Mean per item over the rows present in the last ``n`` days of its series."""
    recent = daily.join(last_dates(daily, series), list(series)).where(
        F.col("order_date").between(F.date_sub("max_date", n - 1), F.col("max_date"))
    )
    return recent.groupBy(*item).agg(*[money_avg(m).alias(m) for m in measures])


def days_to_fill(last: Column | str, horizon: int, as_of: date) -> Column:
    """Dates after ``last``, at most ``horizon``, up to the day before ``as_of``.

    Empty if there is none: ``sequence`` would count downwards instead.
    """
    last = F.col(last) if isinstance(last, str) else last
    stop = F.least(F.date_add(last, horizon), F.lit(as_of - timedelta(days=1)))
    days = F.sequence(F.date_add(last, 1), stop, F.expr("interval 1 day"))
    return F.when(stop > last, days).otherwise(F.array().cast("array<date>"))


def future_dates(last: DataFrame, horizon: int = HORIZON, as_of: date | None = None) -> DataFrame:
    """Days to project per series, with their distance from its last day."""
    keys = [c for c in last.columns if c != "max_date"]
    days = last.select(*keys, "max_date", F.explode(days_to_fill("max_date", horizon, as_of)).alias("order_date"))
    ahead = F.datediff("order_date", "max_date").cast("bigint").alias("days_ahead")
    return days.select(*keys, "order_date", ahead)


def project_flat(
    means: DataFrame,
    last: DataFrame,
    actuals: DataFrame,
    as_of: date,
    horizon: int = HORIZON,
    series: Sequence[str] = SERIES,
) -> DataFrame:
    """Actual rows and, per item, one row with its mean for each day to fill.

    An item meets its series as one row and makes its days itself; items and days of a
    series are never joined with one another.
    """
    days = F.explode(days_to_fill("max_date", horizon, as_of)).alias("order_date")
    filled = means.join(last, list(series)).select(*means.columns, "max_date", days)
    filled = filled.withColumns(
        {
            "days_ahead": F.datediff("order_date", "max_date").cast("bigint"),
            "is_projected": F.lit(True),
        }
    ).drop("max_date")
    real = actuals.withColumns(
        {"days_ahead": F.lit(0).cast("bigint"), "is_projected": F.lit(False)}
    )
    return real.unionByName(filled)


def rolling_projection(
    df: DataFrame,
    keys: Sequence[str] = (*SERIES, *LABELS),
    back: int = 7,
    measures: Sequence[str] = MEASURES,
) -> DataFrame:
    """Replace projected values by the mean of the ``back`` days before them.

    The mean is over all rows, actual or first-pass, of the same keys; with a NULL key there
    is none.  Rows are summed per (keys, day), each day is handed to the ``back`` days after
    it and summed again: every step combines before its shuffle, and no window holds a
    whole series.
    """
    dated = df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    per_day = dated.groupBy(*keys, "order_date").agg(
        *[F.sum(F.col(m).cast(FINE)).alias(f"_s_{m}") for m in measures],
        *[F.count(m).alias(f"_n_{m}") for m in measures],
    )
    ahead = F.sequence(F.lit(1), F.lit(back))
    handed = per_day.withColumn("_ahead", F.explode(ahead)).withColumn(
        "order_date", F.date_add("order_date", F.col("_ahead"))
    )
    means = handed.groupBy(*keys, "order_date").agg(
        *[
            F.try_divide(
                F.sum(f"_s_{m}").cast("double"), F.sum(f"_n_{m}").cast("double")
            ).alias(f"_mean_{m}")
            for m in measures
        ]
    )
    projected = lookup(df.where("is_projected"), means, [*keys, "order_date"])
    rolled = projected.withColumns({m: F.col(f"_mean_{m}") for m in measures})
    kept = [c for c in df.columns if c != "days_ahead"]
    return df.where(~F.col("is_projected")).select(*kept).unionByName(rolled.select(*kept))


def unpivot_targets(df: DataFrame, columns: dict[str, str], month: str = "month") -> DataFrame:
    """One row per month and channel with a target; ``columns`` maps column to channel."""
    long = df.select(F.to_date(month).alias("month"), *columns).unpivot(
        ["month"], list(columns), "_column", "monthly_target"
    )
    names = F.create_map(*[F.lit(x) for pair in columns.items() for x in pair])
    return long.where(F.col("monthly_target").isNotNull()).select(
        "month", names[F.col("_column")].alias("channel"), F.col("monthly_target").cast("double")
    )


def latest_month(daily: DataFrame, series: Sequence[str] = ("channel",)) -> DataFrame:
    """Rows of the last month with data of each series, with ``month``."""
    months = daily.withColumn("month", month_start("order_date"))
    last = months.groupBy(*series).agg(F.max("month").alias("month"))
    return months.join(last, [*series, "month"], "left_semi")


def selling_price(daily: DataFrame, by: Sequence[str] = ("channel",)) -> DataFrame:
    """Average selling price of the latest month: one per channel, as targets are."""
    units = F.nullif(money_sum("units_sold"), F.lit(0.0))
    return latest_month(daily).groupBy(*by).agg(
        F.try_divide(money_sum("gmv"), units).alias("avg_selling_price")
    )


def daily_target(targets: DataFrame, asp: DataFrame) -> DataFrame:
    """Value and unit target per day of the month."""
    price = F.nullif(F.col("avg_selling_price"), F.lit(0.0))
    days = days_in_month("month")
    return (
        targets.join(asp.select("channel", "avg_selling_price"), "channel", "left")
        .withColumn("days_in_month", days)
        .withColumn("daily_target", F.col("monthly_target") / days.cast("double"))
        .withColumn("daily_units_target", F.try_divide(F.col("daily_target"), price))
        .select("channel", "month", "monthly_target", "days_in_month", "daily_target", "daily_units_target")
    )


def contribution(
    daily: DataFrame,
    by: Sequence[str] = tuple(c for c in ITEM if c != "source_channel"),
    within: Sequence[str] = ("channel",),
) -> DataFrame:
    """Share of every item in the value and units of its channel's latest month."""
    rows = latest_month(daily, within)
    items = rows.groupBy(*by).agg(
        money_sum("gmv").alias("sku_monthly_gmv"),
        money_sum("units_sold").alias("sku_monthly_units"),
    )
    totals = rows.groupBy(*within).agg(
        money_sum("gmv").alias("_gmv"), money_sum("units_sold").alias("_units")
    )
    return (
        items.join(totals, list(within))
        .withColumns(
            {
                "sku_contribution_pct": F.try_divide("sku_monthly_gmv", "_gmv"),
                "sku_units_contribution_pct": F.try_divide("sku_monthly_units", "_units"),
            }
        )
        .drop("_gmv", "_units")
    )


def allocate_target(
    targets: DataFrame,
    shares: DataFrame,
    months_with_data: DataFrame,
    as_of: date,
    brand: str,
    marketplaces: Sequence[str] = (),
) -> DataFrame:
    """Daily target rows of months without data, split over the channel's items.

    A channel without items gets one unlabelled row per day.  Items meet their channel's
    months first and the days are made on the joined row.
    """
    open_months = targets.join(months_with_data, ["channel", "month"], "left_anti")
    kind = F.when(F.col("channel").isin(*marketplaces), "Marketplace").otherwise("Offline")
    items = open_months.join(shares, "channel")
    orphans = open_months.join(shares.select("channel").distinct(), "channel", "left_anti")
    value = F.col("daily_target") * F.coalesce("sku_contribution_pct", F.lit(0.0))
    none = F.lit(None).cast("string")
    stop = F.least(F.last_day("month"), F.lit(as_of - timedelta(days=1)))
    days = F.when(stop >= F.col("month"), F.sequence("month", stop, F.expr("interval 1 day")))

    def rows(df: DataFrame, labels: dict[str, Column], gmv: Column, units: Column) -> DataFrame:
        return df.withColumn("order_date", F.explode(days)).select(
            *[labels.get(c, F.col(c)).alias(c) for c in FACT_DIMS],
            gmv.alias("gmv"),
            gmv.alias("gross_sales"),
            units.alias("units_sold"),
            F.lit(True).alias("is_projected"),
        )

    units = F.col("daily_units_target")
    split = rows(
        items, {"source_channel": kind}, value,
        units * F.coalesce("sku_units_contribution_pct", F.lit(0.0)),
    )
    labels = {
        "brand": F.lit(brand), "com": none, "source_channel": kind, "parent_sku": none,
        **{c: none for c in LABELS}, "region": F.lit("null"),
    }
    return split.unionByName(rows(orphans, labels, F.col("daily_target"), units))


def projected_union(parts: Sequence[DataFrame]) -> DataFrame:
    """Actual and projected rows of all kinds under one another."""
    columns = [*FACT_DIMS, *MEASURES, "is_projected"]
    return reduce(lambda a, b: a.unionByName(b), [p.select(*columns) for p in parts])


def month_rollup(df: DataFrame, item: Sequence[str] = ITEM) -> DataFrame:
    """Sums per month and item with the last day seen."""
    return df.groupBy(month_start("order_date").alias("month"), *item).agg(
        F.max("order_date").alias("max_date"), *[money_sum(m).alias(m) for m in MEASURES]
    )


def last_month_to_date(df: DataFrame, as_of: date, by: Sequence[str]) -> DataFrame:
    """Previous month's sales up to yesterday's day number, per the keys they are joined on.

    On the first of a month that is the whole previous month.
    """
    previous = (as_of.replace(day=1) - timedelta(days=1)).replace(day=1)
    upto = (as_of - timedelta(days=1)).day
    rows = df.where(
        (F.col("order_date") >= F.lit(previous))
        & (F.col("order_date") < F.lit(as_of.replace(day=1)))
        & (F.dayofmonth("order_date") <= upto)
    )
    return rows.groupBy(month_start("order_date").alias("month"), *by).agg(
        money_sum("gross_sales").alias("lmtd_gross")
    )


def target_allocation(
    months: DataFrame,
    targets: DataFrame,
    keys: Sequence[str],
    tiebreak: Sequence[str],
    guard: Column,
) -> DataFrame:
    """Put the target of a group on its first row only, with the target per day.

    ``tiebreak`` orders the rows of a group (NULLs first) and must identify them.  The first
    row is the least struct of the tiebreak, an aggregate that combines before the shuffle;
    a window would hold the whole group in one task.  Markers of missing labels become NULL,
    and ``guard`` says which rows may carry a target.
    """
    marked = ["main_category", "product_title"]
    wanted = targets.select(
        *[null_marker(k).alias(k) if k in marked else F.col(k) for k in keys], "final_product_target"
    )
    wanted = wanted.groupBy(*keys).agg(money_sum("final_product_target").alias("_target"))
    first = months.groupBy(*keys).agg(F.min(F.struct(*tiebreak)).alias("_first"))
    chosen = first.join(wanted, list(keys)).select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        *[F.col(f"_first.{t}").alias(f"_t_{t}") for t in tiebreak],
        "_target",
    )
    same = [F.col(k) == F.col(f"_k_{k}") for k in keys]
    same += [F.col(t).eqNullSafe(F.col(f"_t_{t}")) for t in tiebreak]
    joined = months.join(chosen, reduce(lambda a, b: a & b, same), "left")
    target = F.when(guard, F.col("_target"))
    per_day = F.try_divide(target, days_in_month("month").cast("double"))
    return joined.select(
        *months.columns, target.alias("final_product_target"), per_day.alias("product_target")
    )
