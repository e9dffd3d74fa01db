"""Many sales feeds, each described by a spec, united into one fact table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import FINE, money_sum
from .dedupe import dedupe_any, pick_preferred
from .joins import lookup
from .reshape import days_in_month, days_of_month, spread_month

DIMS = [
    "brand", "source_channel", "channel", "com", "order_date", "product_id", "parent_sku",
    "master_sku", "product_title", "master_title", "mrp_og", "main_category", "sub_category",
    "region",
]
FACT_DIMS = [
    "brand", "com", "source_channel", "channel", "order_date", "parent_sku", "product_title",
    "master_title", "main_category", "sub_category", "region",
]
MEASURES = ["gmv", "gross_sales", "units_sold"]
LABELS = ["brand", "com", "source_channel", "channel"]
PRODUCT_DIMS = ["parent_sku", "product_title", "master_title", "main_category", "sub_category"]


@dataclass(frozen=True)
class ChannelSpec:
    """How one feed becomes sales rows.  Expressions are SQL text over the feed's columns.

    ``gmv``, ``sales`` and ``units`` are summed; ``gmv_price``/``sales_price`` name a mapping
    column that multiplies the sum, ``sales_factor`` a constant that does.  ``source_mrp``
    takes the list price from the feed instead of the mapping.  ``mapping`` and
    ``guard`` choose the product mapping and its channel, and ``mapped_only`` drops products
    it lacks.  ``monthly`` spreads monthly rows over their days.
    """

    brand: str
    source_channel: str
    channel: str
    com: str
    feed: str
    date: str = "order_date"
    product: str | None = "product_id"
    key: str | None = None
    gmv: str = "gmv"
    sales: str = "gross_sales"
    units: str | None = "units_sold"
    gmv_price: str | None = None
    sales_price: str | None = None
    sales_factor: str | None = None
    where: str | None = None
    mapping: str = "master"
    guard: str | None = None
    guard_any_case: bool = False
    mapped_only: bool = False
    monthly: bool = False
    mrp: str | None = "mrp_og"
    source_mrp: str | None = None
    default_category: str | None = None
    category_fix: tuple[str, str] | None = None
    region: str | None = None


def mapping_rows(mapping: DataFrame, spec: ChannelSpec) -> DataFrame:
    """Mapping rows the spec may use."""
    if spec.guard is None:
        return mapping
    channel = F.lower("map_channel") if spec.guard_any_case else F.col("map_channel")
    return mapping.where(channel == (spec.guard.lower() if spec.guard_any_case else spec.guard))


def channel_rows(src: DataFrame, spec: ChannelSpec, mapping: DataFrame) -> DataFrame:
    """Sales rows of one feed, one per day, product and mapping row.

    The feed is summed by (day, product, key, region) before the mapping join, so the join
    meets a best-seller as one row per day, not as all its order lines.  ``mapping`` has
    ``map_key``, ``map_channel`` and the product columns.
    """
    base = _summed(src, spec, ["order_date", "product_id", "_key", "region", "_mrp"])
    joined = _mapped(base, spec, mapping_rows(mapping, spec).drop("map_channel"))
    out = joined.select(
        F.lit(spec.brand).alias("brand"),
        F.lit(spec.source_channel).alias("source_channel"),
        F.lit(spec.channel).alias("channel"),
        F.lit(spec.com).alias("com"),
        "order_date",
        "product_id",
        "parent_sku",
        "master_sku",
        "product_title",
        "master_title",
        F.coalesce("_mrp", F.col(spec.mrp) if spec.mrp else F.lit(None)).cast("double").alias("mrp_og"),
        _category(spec).alias("main_category"),
        "sub_category",
        "region",
        *_amounts(spec),
    )
    if spec.monthly:
        out = spread_month(out, "order_date", MEASURES).select(*DIMS, *MEASURES)
    return out


def _summed(src: DataFrame, spec: ChannelSpec, by: Sequence[str]) -> DataFrame:
    """The feed of a spec summed by some of its columns; days of a monthly feed are its months."""
    rows = src if spec.where is None else src.where(spec.where)
    product = F.expr(spec.product).cast("string") if spec.product else F.lit(None).cast("string")
    key = F.expr(spec.key or spec.product).cast("string")
    region = F.expr(spec.region).cast("string") if spec.region else F.lit("null")
    measures = {"gmv": spec.gmv, "gross_sales": spec.sales, "units_sold": spec.units}
    base = rows.select(
        F.to_date(F.expr(spec.date)).alias("order_date"),
        product.alias("product_id"),
        key.alias("_key"),
        region.alias("region"),
        (F.expr(spec.source_mrp) if spec.source_mrp else F.lit(None)).cast("double").alias("_mrp"),
        *[
            (F.expr(e) if e else F.lit(None)).try_cast(FINE).alias(m) for m, e in measures.items()
        ],
    )
    if spec.monthly:
        base = base.withColumn("order_date", F.trunc("order_date", "MM"))
    return base.groupBy(*by).agg(*[F.sum(m).alias(m) for m in MEASURES])


def _mapped(base: DataFrame, spec: ChannelSpec, products: DataFrame) -> DataFrame:
    how = "inner" if spec.mapped_only else "left"
    return base.join(products, F.col("_key") == F.col("map_key"), how)


def _category(spec: ChannelSpec) -> Column:
    category = F.col("main_category")
    if spec.default_category is not None:
        category = F.coalesce(category, F.lit(spec.default_category))
    if spec.category_fix is not None:
        word, label = spec.category_fix
        category = F.when(F.lower(category) == word, label).otherwise(category)
    return category


def _amounts(spec: ChannelSpec) -> list[Column]:
    gmv, sales = F.col("gmv").cast("double"), F.col("gross_sales").cast("double")
    if spec.gmv_price:
        gmv = gmv * F.col(spec.gmv_price)
    if spec.sales_price:
        sales = sales * F.col(spec.sales_price)
    if spec.sales_factor:
        sales = margin_factor(sales, spec.sales_factor)
    return [gmv.alias("gmv"), sales.alias("gross_sales"), F.col("units_sold").cast("double").alias("units_sold")]


def _product_rows(spec: ChannelSpec, mapping: DataFrame) -> DataFrame:
    """Mapping rows with the product columns of the fact and ``_product``, 128 bits that stand for these.

    ``_product`` is NULL for a row that has at most a category, which is like a product without a row.
    """
    rows = mapping.withColumn("main_category", _category(spec).cast("string"))
    named = F.coalesce(*[F.col(c).cast("string") for c in PRODUCT_DIMS if c != "main_category"]).isNotNull()
    return rows.withColumn("_product", F.when(named, F.unhex(F.md5(F.to_json(F.struct(*PRODUCT_DIMS)).cast("binary")))))


def _coded_rows(src: DataFrame, spec: ChannelSpec, mapping: DataFrame, label: int) -> DataFrame:
    """What :func:`channel_rows` gives the fact, with a number for the labels and ``_product`` for the product columns.

    Rows without a product have their category in ``_filled``.  Monthly rows stay so.
    """
    products = _product_rows(spec, mapping_rows(mapping, spec)).select(
        "map_key", "mrp_og", "mrp_rev", "_product", F.when(F.col("_product").isNull(), F.col("main_category")).alias("_only")
    )
    joined = _mapped(_summed(src, spec, ["order_date", "_key", "region"]), spec, products)
    unknown = joined.withColumn("main_category", F.lit(None).cast("string"))
    filled = F.when(F.col("map_key").isNull(), _category(spec).cast("string")).otherwise(F.col("_only"))
    return unknown.select(F.lit(label).alias("_label"), "order_date", "_product", filled.alias("_filled"), "region", *_amounts(spec))


def channel_sales(src: DataFrame, spec: ChannelSpec, mapping: DataFrame) -> DataFrame:
    """Sales of one feed, one row per combination of its dimensions."""
    return channel_rows(src, spec, mapping).groupBy(*DIMS).agg(
        *[money_sum(m).alias(m) for m in MEASURES]
    )


def margin_factor(col, factor: str):
    """A measure times a fixed share, given as decimal text."""
    return (col.cast(FINE) * F.lit(factor).cast("decimal(6,4)")).cast("double")


def union_channels(parts: Sequence[DataFrame]) -> DataFrame:
    """All branches under one another, with the same columns and types."""
    return reduce(lambda a, b: a.unionByName(b), parts)


def discounted_sales(
    df: DataFrame, discounts: DataFrame, keys: Sequence[str], cutover: date
) -> DataFrame:
    """``gross_sales`` as reported from ``cutover`` on; before it GMV less the discount.

    Of several discounts for the same keys the largest counts.
    """
    early = F.col("gmv") * (F.lit(1) - F.coalesce("_discount", F.lit(0.0)))
    card = discounts.groupBy(*keys).agg(F.max("discount").alias("_discount"))
    return (
        lookup(df, card, list(keys))
        .withColumn(
            "gross_sales",
            F.when(F.col("order_date") >= F.lit(cutover), F.col("gross_sale")).otherwise(early),
        )
        .drop("_discount")
    )


def sales_fact(unioned: DataFrame, as_of: date) -> DataFrame:
    """Sums over eleven dimensions for the days before ``as_of``; no sum is NULL."""
    return (
        unioned.where(F.col("order_date") < F.lit(as_of))
        .groupBy(*FACT_DIMS)
        .agg(
            *[
                F.coalesce(money_sum(m), F.lit(0.0)).alias(m)
                for m in MEASURES
            ]
        )
    )


def _coded_fact(rows: DataFrame, products: DataFrame, labels: Sequence[tuple], as_of: date, monthly: bool = False) -> DataFrame:
    """Sums of coded rows over eleven dimensions for the days before ``as_of``; no sum is NULL.

    The rows are dealt out once, by product, for the sums and for the product columns; rows without a
    product are dealt out by label and day.  Monthly rows are grouped before they are spread: all days of a
    month get the same share of a row, so the sum of the shares is the sum of each day.
    """
    early = F.col("order_date") < F.lit(as_of)
    rows = rows.where(early)
    if monthly:
        days = days_in_month("order_date").cast("double")
        rows = rows.withColumns({m: F.col(m).cast("double") / days for m in MEASURES})
    spread = F.unhex(F.md5(F.concat_ws(",", F.lit("no product"), "_label", "order_date").cast("binary")))
    dealt = rows.withColumn("_dealt", F.coalesce("_product", spread)).drop("_product").repartition("_dealt")
    sums = dealt.groupBy("_dealt", "_label", "order_date", "_filled", "region").agg(
        *[F.coalesce(money_sum(m), F.lit(0.0)).alias(m) for m in MEASURES]
    )
    found = sums.join(products, F.col("_dealt") == F.col("_product"), "left").withColumn(
        "main_category", F.coalesce("main_category", "_filled")
    )
    at = F.element_at(F.array(*[F.struct(*[F.lit(v).alias(c) for c, v in zip(LABELS, x)]) for x in labels]), F.col("_label") + 1)
    found = found.withColumns({c: at[c] for c in LABELS}).select(*FACT_DIMS, *MEASURES)
    if not monthly:
        return found
    day = F.explode(days_of_month("order_date")).alias("order_date")
    return found.select(*[day if c == "order_date" else c for c in found.columns]).where(early)


# --- product mappings in the layout that channel_sales expects ---

MAP_COLUMNS = [
    "map_key", "map_channel", "parent_sku", "master_sku", "product_title", "master_title",
    "mrp_og", "mrp_rev", "main_category", "sub_category",
]


def master_mapping(products: DataFrame) -> DataFrame:
    """Variant ids of the main brand."""
    return products.select(
        F.col("variant_id").cast("string").alias("map_key"),
        F.col("channel").alias("map_channel"),
        "parent_sku", "master_sku", "product_title", "master_title", "mrp_og", "mrp_rev",
        "main_category", "sub_category",
    )


def preferred_mapping(products: DataFrame, channel: str) -> DataFrame:
    """One row per variant id, that of ``channel`` if it has one."""
    return pick_preferred(
        master_mapping(products),
        ["map_key"],
        F.col("map_channel") == channel,
        ["map_channel", *MAP_COLUMNS[2:]],
    )


def offline_mapping(products: DataFrame) -> DataFrame:
    """One row per offline SKU."""
    one = dedupe_any(
        products, ["sku"], ["product_name", "master_title", "main_category", "sub_category", "mrp"]
    )
    none = F.lit(None).cast("string")
    return one.select(
        F.col("sku").alias("map_key"), none.alias("map_channel"), F.col("sku").alias("parent_sku"),
        none.alias("master_sku"), F.col("product_name").alias("product_title"), "master_title",
        F.col("mrp").try_cast("double").alias("mrp_og"), F.lit(None).cast("double").alias("mrp_rev"),
        "main_category", "sub_category",
    )


def export_mapping(products: DataFrame) -> DataFrame:
    """One row per product id of the export division."""
    rows = products.where(F.lower("division").like("%export%"))
    one = dedupe_any(
        rows, ["product_id"], ["parent_sku", "master_sku", "product_title", "master_title", "mrp"]
    )
    return one.select(
        F.col("product_id").cast("string").alias("map_key"),
        F.lit(None).cast("string").alias("map_channel"),
        "parent_sku", "master_sku", "product_title", "master_title",
        F.col("mrp").try_cast("double").alias("mrp_og"), F.lit(None).cast("double").alias("mrp_rev"),
        "main_category", "sub_category",
    )


def marketplace_mapping(products: DataFrame) -> DataFrame:
    """Marketplace identifiers of the second brand."""
    return products.select(
        F.col("identifier").alias("map_key"), F.col("channel").alias("map_channel"),
        F.col("sku").alias("parent_sku"), F.col("main_sku").alias("master_sku"),
        F.col("product_name").alias("product_title"), F.col("product_name").alias("master_title"),
        F.col("mrp").cast("double").alias("mrp_og"), F.lit(None).cast("double").alias("mrp_rev"),
        F.col("category").alias("main_category"), F.lit("null").alias("sub_category"),
    )


def sales_union(
    feeds: Mapping[str, DataFrame],
    mappings: Mapping[str, DataFrame],
    specs: Sequence[ChannelSpec],
    as_of: date,
) -> DataFrame:
    """The sales fact over every spec.

    The branches are not grouped one by one: the fact groups them once.  Rows meet that shuffle with a number
    for their labels and 128 bits for their product columns, which are looked up after the sums.  Monthly
    branches that share their labels with no daily one are grouped by month and spread last, so the shuffle
    meets a month of a product as one row, not as its days.
    """
    def label(s: ChannelSpec) -> tuple:
        return tuple(getattr(s, c) for c in LABELS)

    labels = sorted({label(s) for s in specs})
    daily = {label(s) for s in specs if not s.monthly}
    late = [s for s in specs if s.monthly and label(s) not in daily]
    soon = [s for s in specs if s not in late]
    kinds = {(s.mapping, s.default_category, s.category_fix): s for s in specs}
    every = union_channels([_product_rows(s, mappings[s.mapping]).select("_product", *PRODUCT_DIMS) for s in kinds.values()])
    products = dedupe_any(every.where(F.col("_product").isNotNull()), ["_product"], ["_product"])

    def coded(s: ChannelSpec) -> DataFrame:
        rows = _coded_rows(feeds[s.feed], s, mappings[s.mapping], labels.index(label(s)))
        if s.monthly and s in soon:
            rows = spread_month(rows, "order_date", MEASURES).select(*rows.columns)
        return rows

    facts = [
        _coded_fact(union_channels([coded(s) for s in some]), products, labels, as_of, monthly)
        for some, monthly in ((soon, False), (late, True))
        if some
    ]
    return union_channels(facts)
