"""Actual sales, projected days, targets and month comparisons in one report."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timing import month_start
from ..operators import projection as p
from ..operators.sales import FACT_DIMS, MEASURES

# Target column -> channel; all but the last are marketplaces.
TARGET_CHANNELS = {
    "smytten": "Smytten", "purplle": "Purplle", "first_cry": "First Cry", "export": "Export",
}
TARGET_MARKETPLACES = ["Smytten", "Purplle", "First Cry"]
LMTD_KEYS = [
    "brand", "channel", "parent_sku", "product_title", "master_title", "main_category",
    "sub_category",
]


def projected_sales(
    fact: DataFrame,
    channel_targets: DataFrame,
    target_brand: str,
    as_of: date,
    target_columns: dict[str, str] | None = None,
    marketplaces: Sequence[str] = TARGET_MARKETPLACES,
) -> DataFrame:
    """Daily rows: actual, projected by rolling mean, or projected from channel targets."""
    target_columns = TARGET_CHANNELS if target_columns is None else target_columns
    by_target = (F.col("brand") == target_brand) & F.col("channel").isin(*target_columns.values())
    daily = p.daily_agg(fact)
    rolled, targeted = daily.where(~by_target), daily.where(by_target)

    last = p.last_dates(rolled)
    flat = p.project_flat(p.trailing_mean(rolled), last, rolled, as_of)
    rolling = p.rolling_projection(flat)

    targets = p.daily_target(
        p.unpivot_targets(channel_targets, target_columns), p.selling_price(targeted)
    )
    with_data = targeted.select("channel", month_start("order_date").alias("month")).distinct()
    allocated = p.allocate_target(
        targets, p.contribution(targeted), with_data, as_of, target_brand, marketplaces
    )
    actual = targeted.select(*FACT_DIMS, *MEASURES, F.lit(False).alias("is_projected"))
    return p.projected_union([rolling, actual, allocated])


def sales_report(
    fact: DataFrame,
    channel_targets: DataFrame,
    product_targets: DataFrame,
    target_brand: str,
    as_of: date,
    target_columns: dict[str, str] | None = None,
    marketplaces: Sequence[str] = TARGET_MARKETPLACES,
) -> DataFrame:
    """Month sums per item with targets and the previous month to date."""
    rows = projected_sales(
        fact, channel_targets, target_brand, as_of, target_columns, marketplaces
    )
    months = p.month_rollup(rows).where(F.col("month") < F.lit(as_of))
    lmtd = p.last_month_to_date(rows, as_of, LMTD_KEYS).withColumn("month", F.add_months("month", 1))
    report = p.target_allocation(
        months,
        product_targets.withColumn("month", F.to_date("month")),
        ["month", "channel", "main_category", "product_title"],
        ["parent_sku", "master_title", "sub_category", "brand", "com", "source_channel", "region"],
        F.col("brand") == target_brand,
    )
    return report.join(lmtd, ["month", *LMTD_KEYS], "left")
