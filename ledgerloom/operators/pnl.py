"""Daily profit and loss of a web shop."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import FINE, money, money_sum, safe_number
from .dedupe import dedupe_any, dedupe_latest
from .joins import lookup

# Tax rates and the titles and categories of the low rate.
LOW_RATE, FULL_RATE = 0.05, 0.18
LOW_RATE_TITLES = ["%hair oil%", "%compact powder%"]
LOW_RATE_CATEGORIES = ["%shampoo%"]
KIT_TYPES = ["combo", "physicalkit"]
FAILED_STATUSES = [
    "RTO-Delivered", "RTO-Marked", "RTO-InTransit", "RTO-OutForDelivery", "RTO-Failed",
    "RTO-Requested", "Lost", "Damaged", "FailedDelivery", "PickupFailed",
]
FREEBIE_SKUS = [
    "PGJB%", "SAM%", "%MINI%", "%GIFT%", "%PG-CL25%", "%PG-RB1%", "%PG-RMB2%", "%PG-GMP1%",
]
FREEBIE_TITLES = ["%bag%", "%pouch%"]
COGS_FALLBACK = 0.15
SHIPPING_FALLBACK = 40
INWARD_RATE, TXN_RATE, PROCESS_RATE = 0.007, 0.0065, 0.015
TRACKING_LEAD_DAYS = 30


def like_any(col: Column, patterns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [col.like(p) for p in patterns])


def inside(rate: float) -> float:
    """Share of a gross price that is tax at ``rate``."""
    return rate / (1 + rate)


def low_rate(
    title: Column | str = "master_title",
    category: Column | str = "sub_category",
    titles: Sequence[str] = LOW_RATE_TITLES,
    categories: Sequence[str] = LOW_RATE_CATEGORIES,
) -> Column:
    return like_any(F.lower(title), titles) | like_any(F.lower(category), categories)


def kit_rates(catalogue: DataFrame, low: Column | None = None) -> DataFrame:
    """Tax factor per kit SKU.  A SKU listed with both rates takes the higher one, so a
    kit never doubles its order lines."""
    factor = F.when(low_rate() if low is None else low, inside(LOW_RATE)).otherwise(inside(FULL_RATE))
    kits = catalogue.where(
        F.lower("type_of_product").isin(*KIT_TYPES) & F.col("parent_sku").isNotNull()
    )
    return kits.groupBy("parent_sku").agg(F.max(factor).alias("tax_factor"))


def embedded_tax(lines: DataFrame, kits: DataFrame, low: Column | None = None) -> DataFrame:
    """Add ``item_gst``, the tax contained in ``item_selling_rev``."""
    by_line = F.when(low_rate() if low is None else low, inside(LOW_RATE)).otherwise(inside(FULL_RATE))
    factor = F.coalesce("tax_factor", by_line)
    joined = lookup(lines, kits, ["parent_sku"])
    return joined.withColumn("item_gst", F.col("item_selling_rev") * factor).drop("tax_factor")


def order_lines(
    shop_lines: DataFrame, catalogue: DataFrame, start: date, low: Column | None = None
) -> DataFrame:
    """Lines of orders that were not cancelled, from ``start``, with value and tax."""
    lines = shop_lines.where(
        (F.col("order_created_at") >= F.lit(start)) & (F.coalesce("is_cancelled", F.lit(0)) == 0)
    ).select(
        F.to_date("order_created_at").alias("order_date"),
        "order_name",
        "parent_sku",
        "master_title",
        "sub_category",
        "item_quantity",
        "item_mrp_price",
        (F.col("item_mrp_price") * F.col("item_quantity")).alias("item_mrp_value"),
        F.col("item_gross_revenue").alias("item_selling_rev"),
    )
    return embedded_tax(lines, kit_rates(catalogue, low), low)


def failed_orders(
    tracking: DataFrame, start: date, statuses: Sequence[str] = FAILED_STATUSES
) -> DataFrame:
    """Distinct ids of orders that never reached the buyer."""
    since = start - timedelta(days=TRACKING_LEAD_DAYS)
    return (
        tracking.where(
            (F.col("order_date") >= F.lit(since))
            & F.col("clickpost_unified_status").isin(*statuses)
        )
        .select(F.col("order_id").alias("order_name"))
        .distinct()
    )


def gross_daily(lines: DataFrame) -> DataFrame:
    """Per day: distinct orders, revenue, units and list-price value of all lines."""
    return lines.groupBy("order_date").agg(
        F.countDistinct("order_name").alias("gross_orders"),
        money_sum("item_selling_rev").alias("total_selling_rev"),
        money_sum("item_quantity").alias("gross_units"),
        money_sum("item_mrp_value").alias("gmv"),
    )


def returns_daily(lines: DataFrame, failed: DataFrame) -> DataFrame:
    """Per order date: orders, units and list-price value of lines whose order failed."""
    return (
        lookup(lines, failed, ["order_name"], "left_semi")
        .groupBy("order_date")
        .agg(
            F.countDistinct("order_name").alias("rto_orders"),
            money_sum("item_quantity").alias("return_units"),
            money_sum("item_mrp_value").alias("returns_mrp"),
        )
    )


def net_lines(lines: DataFrame, failed: DataFrame) -> DataFrame:
    """Lines whose order did not fail."""
    return lookup(lines, failed, ["order_name"], "left_anti")


def net_sales_daily(lines: DataFrame) -> DataFrame:
    return lines.groupBy("order_date").agg(
        money_sum("item_selling_rev").alias("gross_sales"), money_sum("item_gst").alias("gst")
    )


def asof_dates(
    facts: DataFrame, rates: DataFrame, key: str, fact_date: str, rate_date: str
) -> DataFrame:
    """Per (key, fact date) the latest rate date on or before it; pairs without one drop out.

    Both sides shrink to distinct (key, date) first, so one key contributes at most one
    row per day and side to the window, however many rows it has.
    """
    asked = facts.where(F.col(key).isNotNull()).select(key, F.col(fact_date).alias("_d")).distinct()
    known = rates.where(F.col(key).isNotNull()).select(key, F.col(rate_date).alias("_d")).distinct()
    marked = asked.select(key, "_d", F.lit(True).alias("_asked"), F.lit(False).alias("_rate")).union(
        known.select(key, "_d", F.lit(False), F.lit(True))
    )
    days = marked.groupBy(key, "_d").agg(
        F.max("_asked").alias("_asked"), F.max("_rate").alias("_rate")
    )
    upto = Window.partitionBy(key).orderBy("_d").rowsBetween(Window.unboundedPreceding, 0)
    last = F.max(F.when(F.col("_rate"), F.col("_d"))).over(upto)
    return (
        days.withColumn("_rate_day", last)
        .where(F.col("_asked") & F.col("_rate_day").isNotNull())
        .select(key, F.col("_d").alias(fact_date), F.col("_rate_day").alias("asof_date"))
    )


def asof_rate(
    facts: DataFrame,
    rates: DataFrame,
    key: str,
    fact_date: str,
    rate_date: str,
    value: str,
    ties: str = "all",
) -> DataFrame:
    """Rates in force per distinct (key, fact date).

    Several rates on the same latest date are all kept with ``ties="all"``; ``"one"``
    keeps the lowest value.
    """
    if ties not in ("all", "one"):
        raise ValueError(f"unknown ties {ties!r}")
    pairs = asof_dates(facts, rates, key, fact_date, rate_date)
    card = rates.select(key, F.col(rate_date).alias("asof_date"), value)
    if ties == "one":
        card = dedupe_any(card, [key, "asof_date"], [F.col(value).asc_nulls_last()])
    return pairs.join(card, [key, "asof_date"], "inner").select(key, fact_date, "asof_date", value)


def is_freebie(
    skus: Sequence[str] = FREEBIE_SKUS, titles: Sequence[str] = FREEBIE_TITLES
) -> Column:
    """Three-valued: NULL for an unknown SKU whose title does not match."""
    return like_any(F.col("parent_sku"), skus) | like_any(F.lower("master_title"), titles)


def line_cogs(
    lines: DataFrame,
    cost_history: DataFrame,
    catalogue: DataFrame,
    freebie: Column | None = None,
    fallback: float = COGS_FALLBACK,
) -> DataFrame:
    """Add the cost of goods of every line, regular or freebie, without growing the rows.

    Costs that tie on the same day each count; they are summed per (SKU, day) first, so a
    tie changes the amount and not the number of lines.  ``fallback_lines`` is the number
    of regular costs that had to be estimated.

    Cost and catalogue price are put together per (SKU, day) asked for, so the lines are
    joined once, on a key that spreads a best-seller over its days.
    """
    costs = cost_history.select(
        F.col("sku_name").alias("parent_sku"),
        F.col("date").alias("_cost_date"),
        F.col("cogs_").cast("double").alias("_cost"),
    )
    per_day = (
        asof_rate(lines, costs, "parent_sku", "order_date", "_cost_date", "_cost")
        .groupBy("parent_sku", "order_date")
        .agg(
            F.sum(F.col("_cost").cast("decimal(38,12)")).cast("double").alias("_costs"),
            F.count(F.lit(1)).alias("_n"),
            F.count("_cost").alias("_n_known"),
        )
    )
    catalogue_mrp = (
        catalogue.where(F.col("parent_sku").isNotNull())
        .groupBy("parent_sku")
        .agg(F.max("mrp").cast("double").alias("_catalogue_mrp"))
    )
    asked = lines.where(F.col("parent_sku").isNotNull()).select("parent_sku", "order_date").distinct()
    per_pair = asked.join(per_day, ["parent_sku", "order_date"], "left").join(
        catalogue_mrp, "parent_sku", "left"
    )
    flag = is_freebie() if freebie is None else freebie
    zero = F.lit(0.0)
    qty = F.col("item_quantity")
    known = F.coalesce(F.col("_costs"), zero) * qty
    unknown = F.when(F.col("_n").isNull(), 1).otherwise(F.col("_n") - F.col("_n_known"))
    regular_guess = F.col("item_mrp_price") * F.lit(fallback) * qty
    freebie_guess = F.coalesce("_catalogue_mrp", zero) * F.lit(fallback) * qty

    def cost(guess: Column) -> Column:
        # a NULL guess is skipped by SUM and must not hide a known cost
        return F.coalesce(known, zero) + F.coalesce(guess * F.col("_unknown"), zero)

    return (
        lookup(lines, per_pair, ["parent_sku", "order_date"])
        .withColumns({"_freebie": flag, "_unknown": unknown})
        .withColumns(
            {
                "less_cogs": F.when(~F.col("_freebie"), cost(regular_guess)).otherwise(zero),
                "freebie_cogs": F.when(F.col("_freebie"), cost(freebie_guess)).otherwise(zero),
                "cogs_from_fallback": F.when(
                    ~F.col("_freebie"), F.coalesce(regular_guess * F.col("_unknown"), zero)
                ).otherwise(zero),
                "fallback_lines": F.when(~F.col("_freebie"), F.col("_unknown")).otherwise(0),
            }
        )
        .drop("_costs", "_n", "_n_known", "_catalogue_mrp", "_freebie", "_unknown")
    )


COGS_COLUMNS = ["less_cogs", "freebie_cogs", "cogs_from_fallback"]


def cogs_split(
    lines: DataFrame,
    cost_history: DataFrame,
    catalogue: DataFrame,
    freebie: Column | None = None,
    fallback: float = COGS_FALLBACK,
) -> DataFrame:
    """Per day: regular and freebie cost of goods and how much of it was estimated."""
    return (
        line_cogs(lines, cost_history, catalogue, freebie, fallback)
        .groupBy("order_date")
        .agg(
            *[money_sum(c).alias(c) for c in COGS_COLUMNS],
            F.sum("fallback_lines").cast("bigint").alias("fallback_lines"),
        )
    )


def spend_daily(df: DataFrame, date_col: str, amount: str, out: str = "spend") -> DataFrame:
    """Sum of an amount per calendar day."""
    return df.groupBy(F.to_date(date_col).alias("order_date")).agg(money_sum(amount).alias(out))


def hot_cold_union(
    hot: DataFrame,
    cold: DataFrame,
    as_of: date,
    hot_keys: Sequence[str],
    hot_version: str,
    tiebreak: Sequence[Column | str] = (),
    start: date | None = None,
    out: str = "spend",
) -> DataFrame:
    """Recent days from a feed of repeated extracts, older days from a settled table.

    The boundary is the day before ``as_of``: the hot side starts on it and the cold side
    ends before it, so no day is counted twice.  Both sides have ``date_start``, ``spend``.
    """
    boundary = as_of - timedelta(days=1)
    recent = hot.where(F.col("date_start") >= F.lit(boundary)).withColumn(
        "spend", safe_number("spend")
    )
    recent = dedupe_latest(recent, hot_keys, hot_version, tiebreak)
    settled = cold.where(F.col("date_start") < F.lit(boundary))
    if start is not None:
        settled = settled.where(F.col("date_start") >= F.lit(start))
    day = F.to_date("date_start").alias("date_start")
    both = recent.select(day, F.col("spend").cast("double")).unionByName(
        settled.select(day, F.col("spend").cast("double"))
    )
    return spend_daily(both, "date_start", "spend", out)


def wide_spend(df: DataFrame, columns: Sequence[str], date_col: str = "date") -> DataFrame:
    """Spend columns as numbers, gaps and bad text as 0, summed per day."""
    return df.groupBy(F.to_date(date_col).alias("order_date")).agg(
        *[money_sum(safe_number(c, default=0)).alias(c) for c in columns]
    )


def order_shipping(charges: DataFrame) -> DataFrame:
    """Charge per order after removing repeated (AWB, charge type) rows."""
    charged = charges.where(F.col("charge_type").isNotNull())
    unique = dedupe_any(
        charged, ["awb_no", "charge_type"], [F.col("final_charge").asc_nulls_last(), "order_number"]
    )
    return unique.groupBy(F.col("order_number").alias("order_name")).agg(
        money_sum("final_charge").alias("order_shipping_cost")
    )


def shipping_rollup(
    lines: DataFrame, charges: DataFrame, fallback: float = SHIPPING_FALLBACK
) -> DataFrame:
    """Per day: shipping cost of its orders, a flat amount for an order without a charge."""
    orders = lines.select("order_date", "order_name").distinct()
    cost = F.col("order_shipping_cost")
    return (
        orders.join(order_shipping(charges), "order_name", "left")
        .groupBy("order_date")
        .agg(
            money_sum(F.coalesce(cost, F.lit(float(fallback)))).alias("actual_shipping"),
            F.count_if(cost.isNull()).alias("fallback_orders"),
        )
    )


def daily_totals(
    lines: DataFrame,
    failed: DataFrame,
    charges: DataFrame,
    cost_history: DataFrame,
    catalogue: DataFrame,
    freebie: Column | None = None,
    shipping_fallback: float = SHIPPING_FALLBACK,
) -> DataFrame:
    """Gross, returned, net, cost and shipping figures per day in one pass over the lines.

    Lines are summed per (day, order) before the order joins, so a large order meets the
    failure and shipping lookups as one row, and distinct orders become a plain count.
    """
    sums = {
        "revenue": "item_selling_rev",
        "units": "item_quantity",
        "mrp": "item_mrp_value",
        "gst": "item_gst",
        **{c: c for c in COGS_COLUMNS},
    }
    per_order = (
        line_cogs(lines, cost_history, catalogue, freebie)
        .groupBy("order_date", "order_name")
        .agg(
            *[F.sum(F.col(c).cast(FINE)).alias(n) for n, c in sums.items()],
            F.sum("fallback_lines").alias("fallback_lines"),
        )
    )
    facts = (
        failed.select("order_name", F.lit(True).alias("_failed"), F.lit(None).cast("double").alias("_ship"))
        .union(order_shipping(charges).select("order_name", F.lit(None).cast("boolean"), "order_shipping_cost"))
        .groupBy("order_name")
        .agg(F.max("_failed").alias("_failed"), F.max("_ship").alias("_ship"))
    )
    is_failed = F.coalesce("_failed", F.lit(False))
    total = lambda c: F.sum(F.col(c)).cast("double")
    failed_total = lambda c: F.sum(F.when(is_failed, F.col(c))).cast("double")
    net_total = lambda c: F.sum(F.when(~is_failed, F.col(c))).cast("double")
    return (
        per_order.join(facts, "order_name", "left")
        .groupBy("order_date")
        .agg(
            F.count("order_name").alias("gross_orders"),
            total("revenue").alias("total_selling_rev"),
            total("units").alias("gross_units"),
            total("mrp").alias("gmv"),
            F.count_if(is_failed & F.col("order_name").isNotNull()).alias("rto_orders"),
            failed_total("units").alias("return_units"),
            failed_total("mrp").alias("returns_mrp"),
            net_total("revenue").alias("gross_sales"),
            net_total("gst").alias("gst"),
            *[net_total(c).alias(c) for c in COGS_COLUMNS],
            F.sum(F.when(~is_failed, F.col("fallback_lines"))).alias("fallback_lines"),
            money_sum(F.coalesce("_ship", F.lit(float(shipping_fallback)))).alias("actual_shipping"),
            F.count_if(F.col("_ship").isNull()).alias("fallback_orders"),
        )
    )


def join_daily(gross: DataFrame, *parts: DataFrame) -> DataFrame:
    """Left joins of daily frames on the spine of days with orders."""
    return reduce(lambda a, b: a.join(b, "order_date", "left"), parts, gross)


def pnl_waterfall(
    daily: DataFrame,
    search: str,
    social: str,
    brand_spends: Sequence[str],
    shipping_fallback: float = SHIPPING_FALLBACK,
) -> DataFrame:
    """From list-price value down to the second contribution margin.

    Each subtotal is a column of its own; amounts are decimals and rounded once at the end.
    """
    def amt(c: str) -> Column:
        return F.coalesce(money(c), money(F.lit(0)))

    def part(base: str, rate: float) -> Column:
        return F.col(base) * F.lit(rate).cast("decimal(8,6)")

    d = daily.select(
        F.col("order_date").alias("date"),
        money("gmv").alias("gmv"),
        money("total_selling_rev").alias("gross_without_cancellation"),
        amt("returns_mrp").alias("returns"),
        amt("gross_sales").alias("gross_sales"),
        amt("gst").alias("gst"),
        *[amt(c).alias(c) for c in COGS_COLUMNS],
        F.coalesce("fallback_lines", F.lit(0)).cast("bigint").alias("fallback_lines"),
        F.coalesce(
            money("actual_shipping"), money(F.col("gross_orders") * F.lit(shipping_fallback))
        ).alias("shipping"),
        F.coalesce("fallback_orders", F.lit(0)).cast("bigint").alias("shipping_fallback_orders"),
        amt(search).alias("search"),
        amt(social).alias("social"),
        *[amt(c).alias(c) for c in brand_spends],
    )
    d = d.withColumn("mrp_value", F.col("gmv") - F.col("returns"))
    d = d.withColumns(
        {
            "discounts": F.col("mrp_value") - F.col("gross_sales"),
            "net_sales": F.col("gross_sales") - F.col("gst"),
            "inward_logistics": part("mrp_value", INWARD_RATE),
            "order_proc": part("mrp_value", PROCESS_RATE),
            "brand_marketing": reduce(lambda a, b: a + b, [F.col(c) for c in brand_spends]),
        }
    )
    d = d.withColumns(
        {
            "txn_fees": part("net_sales", TXN_RATE),
            "gross_profit": F.col("net_sales")
            - F.col("less_cogs")
            - F.col("freebie_cogs")
            - F.col("inward_logistics"),
        }
    )
    d = d.withColumn("engagement_fees", F.col("txn_fees") + F.col("order_proc"))
    d = d.withColumn("cm1", F.col("gross_profit") - F.col("engagement_fees") - F.col("shipping"))
    d = d.withColumn(
        "cm2", F.col("cm1") - F.col("search") - F.col("social") - F.col("brand_marketing")
    )
    amounts = [
        "gmv", "gross_without_cancellation", "returns", "mrp_value", "discounts", "gross_sales",
        "gst", "net_sales", *COGS_COLUMNS, "inward_logistics", "gross_profit", "txn_fees",
        "order_proc", "engagement_fees", "shipping", "cm1", "search", "social", *brand_spends,
        "brand_marketing", "cm2",
    ]
    rounded = [F.round(F.col(c), 2).cast("double").alias(c) for c in amounts]
    return d.select("date", *rounded, "fallback_lines", "shipping_fallback_orders")


def pnl_daily(
    gross: DataFrame,
    returns: DataFrame,
    net: DataFrame,
    cogs: DataFrame,
    shipping: DataFrame,
    spends: Sequence[DataFrame],
    search: str,
    social: str,
    brand_spends: Sequence[str],
) -> DataFrame:
    """The waterfall from separately built daily frames, newest day first."""
    daily = join_daily(gross, returns, net, cogs, shipping, *spends)
    return pnl_waterfall(daily, search, social, brand_spends).orderBy(F.desc("date"))
