"""The 31 sales feeds of two brands, as specs, and the feeds that need preparation.

``first`` and ``second`` are the brand labels in the result; ``name`` is the first brand as
the feeds spell it, ``other`` the word that marks products of the second brand.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ids import clean_id
from ..operators import reshape, sales
from ..operators.dedupe import dedupe_any
from ..operators.joins import lookup
from ..operators.sales import ChannelSpec

# Fixed values.
SOLD_STATUSES = [
    "Shipping", "Shipped - Picked Up", "Shipped - Delivered to Buyer",
    "Shipped - Out for Delivery", "Pending", "Pending - Waiting for Pick Up", "Shipped",
]
DISCOUNT_CUTOVER = date(2026, 1, 1)
SHEET_CUTOVER = date(2026, 5, 1)
MT_BA_MARGIN = "0.60"
ORDER_TIME_FORMAT = "d/M/yyyy h:mm:ss a"
WIDE_MONTHS = [
    "jan_25", "feb_25", "mar_25", "apr_25", "may_25", "jun_25", "jul_25", "aug_25", "sep_25",
    "oct_25", "nov_25", "dec_25", "jan_26", "feb_26", "mar_26", "apr_26",
]
SKIN_CARE = ("skincare", "Skin Care")


def safe(c: str) -> str:
    return f"try_cast({c} as double)"


def number(c: str) -> str:
    """Text to number with gaps, bad text and NaN as 0."""
    return f"coalesce(nullif({safe(c)}, double('NaN')), 0)"


def whole(c: str) -> str:
    return f"round({c})"


def bare_id(c: str) -> str:
    return rf"regexp_replace(cast({c} as string), r'\.0$', '')"


def channel_specs(first: str, second: str, name: str, other: str) -> list[ChannelSpec]:
    """All branches in the order of the report."""
    sold = "order_status in (" + ", ".join(f"'{s}'" for s in SOLD_STATUSES) + ")"

    def spec(kind: str, channel: str, com: str, feed: str, **more) -> ChannelSpec:
        return ChannelSpec(first, kind, channel, com, feed, **more)

    def quick(channel: str, feed: str, where: str, **more) -> ChannelSpec:
        return spec(
            "Marketplace", channel, "Q-Com", feed, date="date", product="product",
            gmv=number("off_mrp"), sales=number("off_sp"), units=number("off_qty"), where=where, **more,
        )

    def online(channel: str, feed: str, **more) -> ChannelSpec:
        return spec("Marketplace", channel, "E-Com", feed, **more)

    def offline(channel: str, feed: str, **more) -> ChannelSpec:
        return spec("Offline", channel, channel, feed, **more)

    def theirs(channel: str, com: str, feed: str, product: str, **more) -> ChannelSpec:
        return ChannelSpec(
            second, "Marketplace", channel, com, feed, product=product, mapping="marketplace",
            guard=channel, mapped_only=True, category_fix=SKIN_CARE, **more,
        )

    shop = dict(
        date="order_created_at", product=None, key="item_variant_id", gmv="item_gmv",
        sales="item_gross_revenue", units=whole("item_quantity"), where="is_cancelled = 0",
        mrp=None, default_category="Not filled",
    )
    return [
        spec("Marketplace", "FK Minutes", "Q-Com", "fk_minutes", gmv=safe("gmv"),
             sales=safe("gross_sales"), units="try_cast(units_sold as bigint)",
             guard="flipkart", guard_any_case=True, mapped_only=True),
        spec("Marketplace", "Big Basket", "Q-Com", "big_basket", date="date",
             product="source_sku_id", gmv="total_quantity * total_mrp", sales="total_sales",
             units="total_quantity", where=f"brand_name = '{name}'"),
        quick("Zepto", "zepto", f"brand = '{name}'"),
        quick("Instamart", "instamart", f"lower(brand) = '{name.lower()}'",
              default_category="Not filled"),
        quick("Blinkit", "blinkit", f"brand = '{name}'"),
        online("First Cry", "first_cry", date="date", units=whole("units_sold"), monthly=True),
        online("Smytten", "smytten", date="date", units=whole("units_sold"),
               where="date is not null"),
        online("Flipkart", "flipkart", gmv="gross_units", gmv_price="mrp_og", sales="gmv",
               units=whole("gross_units"), where=f"brand = '{name}'"),
        online("Myntra", "myntra", product="style_id", gmv="item_mrp",
               sales="item_mrp - vendor_funding", units=whole("qty")),
        online("Purplle", "purplle", date="date", sales="gross_sale", units=whole("units_sold")),
        online("Nykaa", "nykaa", date="date", product="`sku code`", gmv="mrp",
               sales="`display price`", units=whole("`total qty`"), guard="Nykaa",
               where=f"brand = '{name}'"),
        online("Amazon", "amazon", date="purchase_date", product="asin", gmv=safe("quantity"),
               gmv_price="mrp_og", sales=safe("item_price"), units="try_cast(quantity as bigint)",
               guard="Amazon", where=f"{sold} and lower(product_name) not like '%{other.lower()}%'"),
        online("Amazon", "amazon_reseller", date="startdate", product="asin", gmv="orderedunits",
               gmv_price="mrp_rev", sales="orderedunits", sales_price="mrp_rev",
               sales_factor="0.77", units=whole("orderedunits"), guard="Amazon"),
        online("Tira", "tira", units=whole("units_sold")),
        online("Meesho", "meesho", product="sku", gmv="quantity", gmv_price="mrp_og",
               sales="gross_sale", units=whole("quantity"), guard="Meesho"),
        spec("D2C", "Shopify", "Shopify", "shop", **shop),
        offline("GT_BA", "gt_ba", product=None, key="vskucode", gmv="sale_value",
                sales="sale_value", sales_factor="0.74", units=whole("quantity"),
                where="sub_type in ('GT-BA', 'GT-RBA') and client_type = 'Retailer-BA'",
                mapping="offline"),
        offline("MT_BA", "mt_ba", product=None, key="product_id", mapping="offline"),
        offline("GT_NBA", "gt_nba", product=None, key="vsku_code", gmv="totalordervaluemrp",
                sales="totalordervaluemrp", sales_factor="0.664",
                units=whole("totalquantitysale"), where="client_type = 'Retailer-NBA'",
                mapping="offline"),
        offline("MT_CORE", "mt_core", product=None, key="component_sku",
                gmv="component_sku_mrp * item_quantity", sales="component_sku_mrp * item_quantity",
                sales_factor="0.444", units="item_quantity", mapping="offline",
                source_mrp="try_cast(component_sku_mrp as double)", mrp=None),
        offline("SALON", "salon", product=bare_id("product_id"),
                gmv="try_cast(grossamount as bigint)", sales="try_cast(order_amt as bigint)",
                units="try_cast(quantity as bigint)", mapping="salon", region="empzone"),
        offline("EBO", "ebo", product=bare_id("product_id"), gmv="sale_value",
                sales="sale_value", sales_factor="0.65", units=whole("quantity"),
                where="division = 'EBO'", guard="EBO"),
        offline("Export", "export", product=bare_id("product_id"), gmv=safe("quantity"),
                gmv_price="mrp_og", sales=safe("sale_value"), units=safe("quantity"),
                mapping="export", monthly=True, default_category="Not filled"),
        theirs("Amazon", "E-Com", "b_amazon", "asin", date="purchase_date", gmv=safe("quantity"),
               gmv_price="mrp_og", sales=safe("item_price"), units="try_cast(quantity as bigint)",
               where=sold),
        theirs("Flipkart", "E-Com", "b_flipkart", "product_id", gmv="gross_units",
               gmv_price="mrp_og", sales="gmv", units=whole("gross_units")),
        theirs("Nykaa", "E-Com", "b_nykaa", "`sku code`", date="date", gmv="mrp",
               sales="`display price`", units=whole("`total qty`"),
               where=f"lower(brand) = '{name.lower()}'"),
        theirs("Myntra", "E-Com", "b_myntra", "style_id", gmv="item_mrp",
               sales="item_mrp - vendor_funding", units=whole("qty")),
        theirs("Blinkit", "Q-Com", "b_blinkit", "item_id", date="date", gmv="mrp_gmv",
               sales="mrp_gmv - total_brand_fund", units="qty_sold"),
        theirs("Purplle", "E-Com", "b_purplle", "sku", gmv="mrp", sales="gross_sales", units=None),
        theirs("Instamart", "Q-Com", "b_instamart", "item_code", gmv="gmv",
               sales="gmv - discount_spend"),
        ChannelSpec(second, "D2C", "Shopify", "Shopify", "b_shop", mapping="b_shop",
                    category_fix=SKIN_CARE, **shop),
    ]


# --- feeds that need more than a projection ---


def wide_months(sheet: DataFrame) -> DataFrame:
    """The sheet with one pair of columns per month, as days with sales at the margin."""
    starts = [date(2025 + i // 12, i % 12 + 1, 1) for i in range(len(WIDE_MONTHS))]
    pairs = {d.isoformat(): (f"{m}_units", f"{m}_revenue") for m, d in zip(WIDE_MONTHS, starts)}
    long = reshape.unpivot_pairs(sheet, ["sku_code"], pairs, ["units", "revenue"])
    months = (
        long.groupBy(F.col("sku_code").cast("string").alias("product_id"), F.to_date("month").alias("month"))
        .agg(F.sum("revenue").alias("gmv"), F.sum("units").alias("units_sold"))
        .withColumn("gross_sales", sales.margin_factor(F.col("gmv"), MT_BA_MARGIN))
    )
    days = reshape.spread_month(months, "month", sales.MEASURES)
    return days.select("order_date", "product_id", *sales.MEASURES)


def mt_ba_feed(sheet: DataFrame, daily: DataFrame, cutover: date = SHEET_CUTOVER) -> DataFrame:
    """Monthly sheet, then the daily sheet from ``cutover``."""
    new = daily.select(
        F.to_date("date").alias("order_date"),
        F.col("sku").cast("string").alias("product_id"),
        F.col("gmv_mrp_qty_").cast("double").alias("gmv"),
        F.col("gross_sales").cast("double").alias("gross_sales"),
        F.col("qty").cast("double").alias("units_sold"),
    )
    return reshape.cutover_union(wide_months(sheet), new, cutover)


def gt_nba_feed(orders: DataFrame, listing: DataFrame) -> DataFrame:
    """Orders with the SKU that the listing gives for the product id."""
    one = dedupe_any(
        listing.select(F.col("product_id").cast("string").alias("_id"), "vsku_code"), ["_id"], ["vsku_code"]
    )
    key = clean_id(F.col("product_id").cast("string"), strip=(".0",), null_words=())
    return lookup(orders.withColumn("_id", key), one, ["_id"])


def mt_core_feed(po: DataFrame, invoices: DataFrame) -> DataFrame:
    """Invoice lines of the purchase orders of one channel, however it is spelled."""
    chosen = po.where(F.col("channel").isin("MT-Core", "Mt-Core", "Mt-core")).select(
        F.trim("po_no").alias("_po")
    )
    lines = invoices.select(
        F.trim("mp_ref_no").alias("_ref"),
        F.to_date("invoice_date").alias("order_date"),
        clean_id(F.trim("component_sku"), strip=("backtick",), null_words=()).alias("component_sku"),
        "component_sku_mrp",
        "item_quantity",
    )
    return chosen.join(lines, F.col("_po") == F.col("_ref"), "left")


def salon_feed(orders: DataFrame) -> DataFrame:
    """Salon orders without test clients and credit lines, text dates parsed."""
    not_credit = ~F.lower("ordertype").like("%credit%")
    kept = orders.where(
        (F.col("client_type") == "Salon") & ~F.lower("client_name").like("%dummy%") & not_credit
    )
    kept = reshape.exclude_groups(kept, "order_id", not_credit)
    return kept.withColumn(
        "order_date", F.to_date(F.to_timestamp("order_date", ORDER_TIME_FORMAT))
    )


def sales_actual(
    feeds: Mapping[str, DataFrame],
    mappings: Mapping[str, DataFrame],
    as_of: date,
    first: str,
    second: str,
    name: str,
    other: str,
) -> DataFrame:
    """The sales fact of both brands over all 31 feeds."""
    return sales.sales_union(feeds, mappings, channel_specs(first, second, name, other), as_of)
