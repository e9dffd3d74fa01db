"""Sales unification."""

from datetime import date

from pyspark.sql import functions as F

from ..operators import reshape, sales
from ..plans import sales_channels as ch
from ..sources.frames import written
from .standins import oracle, order_lines, over_lines, register, table

AS_OF = date(2026, 6, 1)
BRANDS = dict(first="FIRST", second="SECOND", name="Acme", other="Zeta")

register(
    {
        # one wide row per order line with the columns of every feed
        "in_sale": """
            SELECT o_orderkey, l_linenumber, o_orderpriority, CAST(o_orderdate AS DATE) AS order_date,
              CAST(o_orderdate AS DATE) AS date, o_orderdate AS order_created_at, o_orderdate AS purchase_date,
              o_orderdate AS startdate, CAST(l_partkey AS STRING) AS product_id, CAST(l_partkey AS STRING) AS product,
              l_partkey AS source_sku_id, CAST(l_partkey AS STRING) AS style_id, CAST(l_partkey AS STRING) AS sku_code,
              CAST(l_partkey AS STRING) AS asin, CAST(l_partkey AS STRING) AS sku,
              CAST(l_partkey AS STRING) AS item_variant_id, CAST(l_partkey AS STRING) AS vskucode,
              CAST(l_partkey AS STRING) AS item_id, l_partkey AS item_code,
              l_extendedprice AS gmv, l_extendedprice - 1.25 AS gross_sales, l_extendedprice - 2.5 AS gross_sale,
              CASE WHEN l_quantity = 7 THEN 'nan' ELSE CAST(CAST(l_quantity AS BIGINT) AS STRING) END AS units_text,
              l_quantity AS units_sold, l_quantity AS total_quantity, l_quantity * 2 AS total_mrp,
              l_extendedprice AS total_sales,
              CASE WHEN l_linestatus = 'O' THEN 'Acme' WHEN l_returnflag = 'R' THEN 'ACME' ELSE 'Rival' END AS brand,
              CASE WHEN l_quantity < 3 THEN 'nan' WHEN l_quantity < 5 THEN NULL
                   ELSE CAST(l_extendedprice AS STRING) END AS off_mrp,
              CASE WHEN l_quantity < 4 THEN 'x' ELSE CAST(l_extendedprice - 3.5 AS STRING) END AS off_sp,
              CAST(l_quantity AS STRING) AS off_qty, l_quantity AS gross_units, l_extendedprice AS item_mrp,
              l_quantity * 0.5 AS vendor_funding, l_quantity AS qty, l_extendedprice AS mrp,
              l_extendedprice - 4 AS display_price, l_quantity AS total_qty,
              CASE l_returnflag WHEN 'A' THEN 'Shipped' WHEN 'R' THEN 'Cancelled' ELSE 'Pending' END AS order_status,
              CASE WHEN l_tax < 0.03 THEN 'ZETA cream' WHEN l_tax > 0.07 THEN NULL ELSE 'Acme cream' END AS product_name,
              CAST(CAST(l_quantity AS BIGINT) AS STRING) AS quantity, CAST(l_extendedprice AS STRING) AS item_price,
              l_quantity AS orderedunits, CASE WHEN l_tax < 0.04 THEN 'web' ELSE 'app' END AS customer_order_source,
              CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS is_cancelled, l_extendedprice * 2 AS item_gmv,
              l_extendedprice AS item_gross_revenue, l_quantity AS item_quantity,
              CASE l_returnflag WHEN 'A' THEN 'GT-BA' WHEN 'R' THEN 'GT-RBA' ELSE 'OTHER' END AS sub_type,
              CASE WHEN l_linestatus = 'O' THEN 'Retailer-BA' ELSE 'Retailer-NBA' END AS client_type,
              CASE WHEN l_linestatus = 'O' THEN 'EBO' ELSE 'Kiosk' END AS division,
              l_extendedprice AS sale_value, l_extendedprice AS totalordervaluemrp, l_quantity AS totalquantitysale,
              l_extendedprice AS mrp_gmv, l_quantity * 0.25 AS total_brand_fund, l_quantity AS qty_sold,
              l_quantity * 0.75 AS discount_spend
            FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
        "in_sale_float_id": """
            SELECT o_orderkey, o_orderpriority, order_date, product_id || '.0' AS product_id, quantity, sale_value, division, brand
            FROM {in_sale}""",
        "in_salon": """
            SELECT CAST(o_orderkey AS STRING) AS order_id, CAST(l_partkey AS STRING) || '.0' AS product_id,
              CASE WHEN l_linestatus = 'O' THEN 'Salon' ELSE 'Shop' END AS client_type,
              CASE WHEN l_tax = 0.0 THEN 'Dummy one' ELSE 'Real' END AS client_name,
              CASE WHEN l_returnflag = 'R' THEN 'Credit Note' ELSE 'Sale' END AS ordertype,
              CASE WHEN l_suppkey < 40 THEN 'North' WHEN l_suppkey < 70 THEN NULL ELSE 'South' END AS empzone,
              day(o_orderdate) || '/' || month(o_orderdate) || '/' || year(o_orderdate) || ' 9:05:07 PM' AS order_date,
              CAST(CAST(l_quantity AS BIGINT) * 20 AS STRING) AS grossamount,
              CASE WHEN l_quantity = 9 THEN '12.5' ELSE CAST(CAST(l_quantity AS BIGINT) * 15 AS STRING) END AS order_amt,
              CAST(CAST(l_quantity AS BIGINT) AS STRING) AS quantity, l_linenumber
            FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
        "in_master_map": """
            SELECT variant_id, CASE WHEN p_size < 15 THEN 'Flipkart' WHEN p_size < 25 THEN 'Amazon'
                WHEN p_size < 32 THEN 'Nykaa' WHEN p_size < 38 THEN 'Meesho' WHEN p_size < 44 THEN 'EBO'
                ELSE 'Salon' END AS channel, parent_sku, master_sku, product_title, master_title, mrp AS mrp_og,
              mrp - 10 AS mrp_rev, main_category, sub_category
            FROM {part} JOIN {in_products} USING (p_partkey)
            UNION ALL
            SELECT variant_id, 'Salon', parent_sku, master_sku, product_title || ' pro', master_title, mrp + 5, mrp - 5,
              main_category, sub_category
            FROM {part} JOIN {in_products} USING (p_partkey) WHERE p_size < 6""",
        "in_offline_map": """
            SELECT variant_id AS sku, product_title AS product_name, master_title, main_category, sub_category,
              CASE WHEN p_partkey < 100 THEN 'tbd' ELSE CAST(mrp AS STRING) END AS mrp FROM {in_products}
            UNION ALL
            SELECT variant_id, product_title || ' old', master_title, main_category, sub_category, '1' FROM {in_products}
            WHERE mrp < 950""",
        "in_listing": """
            SELECT p_partkey AS product_id, variant_id AS vsku_code FROM {in_products} WHERE type_of_product <> 'Combo'""",
        "in_export_map": """
            SELECT variant_id AS product_id, CASE WHEN mrp < 1500 THEN 'Export Asia' ELSE 'Home' END AS division, parent_sku,
              master_sku, product_title, master_title, CAST(mrp AS STRING) AS mrp, main_category, sub_category
            FROM {in_products}""",
        "in_marketplace_map": """
            SELECT variant_id AS identifier, t.channel, parent_sku AS sku, master_sku AS main_sku, product_title AS product_name,
              mrp, CASE WHEN sub_category = 'LARGE' THEN 'SkinCare' ELSE sub_category END AS category
            FROM {in_products} CROSS JOIN (VALUES ('Amazon'), ('Flipkart'), ('Nykaa'), ('Myntra'), ('Blinkit'), ('Purplle'),
              ('Instamart')) AS t(channel)
            WHERE type_of_product <> 'PhysicalKit'""",
        "in_discounts": """
            SELECT order_date, product_id, customer_order_source, 0.125 AS discount
            FROM {in_sale} WHERE brand = 'Acme' GROUP BY order_date, product_id, customer_order_source""",
        # last sixteen months of orders as one column pair per month
        "in_wide_months": "SELECT l_partkey AS sku_code, "
        + ", ".join(
            f"sum(CASE WHEN year(o_orderdate) * 12 + month(o_orderdate) = {2000 * 12 + 1 + i} THEN l_quantity END) AS {m}_units, "
            f"sum(CASE WHEN year(o_orderdate) * 12 + month(o_orderdate) = {2000 * 12 + 1 + i} AND l_discount > 0.02 "
            f"THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS {m}_revenue"
            for i, m in enumerate(ch.WIDE_MONTHS)
        )
        + " FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey "
        "WHERE l_returnflag = 'R' AND l_linestatus = 'F' GROUP BY l_partkey",
        "in_daily_sheet": """
            SELECT o_orderdate + INTERVAL '25' YEAR AS date, l_partkey AS sku, l_extendedprice AS gmv_mrp_qty_,
              l_extendedprice - 5 AS gross_sales, l_quantity AS qty
            FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
        "in_po": """
            SELECT ' P' || o_orderkey AS po_no, CASE o_orderpriority WHEN '1-URGENT' THEN 'MT-Core'
              WHEN '2-HIGH' THEN 'Mt-core' ELSE 'Other' END AS channel FROM {orders}""",
        "in_invoices": """
            SELECT 'P' || l_orderkey || ' ' AS mp_ref_no, l_shipdate AS invoice_date, '`' || l_partkey AS component_sku,
              l_extendedprice AS component_sku_mrp, l_quantity AS item_quantity FROM {lineitem}""",
    }
)

# which order priority stands for which feed
PRIORITY = {
    "1-URGENT": ["fk_minutes", "smytten", "amazon", "shop", "b_amazon", "b_blinkit"],
    "2-HIGH": ["big_basket", "flipkart", "amazon_reseller", "gt_ba", "b_flipkart", "b_purplle"],
    "3-MEDIUM": ["zepto", "myntra", "gt_nba", "b_nykaa", "b_instamart", "instamart"],
    "4-NOT SPECIFIED": ["purplle", "meesho", "tira", "ebo", "b_myntra", "b_shop"],
    "5-LOW": ["blinkit", "nykaa", "first_cry", "export"],
}
TEXT_UNITS = ["fk_minutes"]
MONTHLY = ["first_cry", "export"]
SPACED = {"sku_code": "sku code", "display_price": "display price", "total_qty": "total qty"}


def _feeds(spark, sf):
    """The feeds, sliced from one copy of the joined lines and orders: it holds the columns of the two that the
    wide stand-in is made from, and each feed makes its own columns from the partition of its priority."""
    source = over_lines(spark, sf, written(order_lines(spark, sf), "o_orderpriority"))
    sale, floats = source("in_sale"), source("in_sale_float_id")
    feeds = {}
    for priority, names in PRIORITY.items():
        for name in names:
            df = floats if name in ("ebo", "export") else sale
            df = df.where(F.col("o_orderpriority") == priority)
            if name in MONTHLY:  # sheets of one product line
                df = df.where(F.col("brand") == "ACME")
            if name in TEXT_UNITS:
                df = df.withColumn("units_sold", F.col("units_text"))
            if name in ("nykaa", "b_nykaa"):
                df = df.withColumnsRenamed(SPACED)
            if name == "big_basket":
                df = df.withColumnRenamed("brand", "brand_name")
            feeds[name] = df
    feeds["tira"] = discounted_feed(feeds["tira"], source("in_discounts"))
    feeds["gt_nba"] = ch.gt_nba_feed(feeds["gt_nba"], source("in_listing"))
    feeds["mt_ba"] = ch.mt_ba_feed(source("in_wide_months"), source("in_daily_sheet"))
    feeds["mt_core"] = ch.mt_core_feed(source("in_po"), source("in_invoices"))
    feeds["salon"] = ch.salon_feed(source("in_salon"))
    return feeds


DISCOUNT_KEYS = ["order_date", "product_id", "customer_order_source"]
CUTOVER = date(1998, 1, 1)


def discounted_feed(feed, discounts):
    return sales.discounted_sales(feed, discounts, DISCOUNT_KEYS, CUTOVER)


def _mappings(spark, sf):
    """Each mapping prepared once and written: every branch that joins it reads the copy."""
    products = table(spark, sf, "in_master_map")
    master = written(sales.master_mapping(products))
    return {
        "master": master,
        "salon": written(sales.preferred_mapping(products, "Salon")),
        "offline": written(sales.offline_mapping(table(spark, sf, "in_offline_map"))),
        "export": written(sales.export_mapping(table(spark, sf, "in_export_map"))),
        "marketplace": written(sales.marketplace_mapping(table(spark, sf, "in_marketplace_map"))),
        "b_shop": master,
    }


def channel_sales(spark, sf):
    """The own-seller branch: guarded mapping, text amounts, status and name filters."""
    spec = next(s for s in ch.channel_specs(**BRANDS) if s.feed == "amazon")
    src = table(spark, sf, "in_sale")
    return sales.channel_sales(src, spec, sales.master_mapping(table(spark, sf, "in_master_map")))


def sales_union(spark, sf):
    return ch.sales_actual(_feeds(spark, sf), _mappings(spark, sf), AS_OF, **BRANDS)


def spread_month(spark, sf):
    """Months are summed first, then spread over their days."""
    sale = table(spark, sf, "in_sale")
    months = sale.groupBy(F.trunc("order_date", "MM").alias("month"), "brand").agg(
        F.sum(F.col("gmv").cast("decimal(28,6)")).alias("gmv"),
        F.sum(F.col("units_sold").cast("decimal(28,6)")).alias("units_sold"),
    )
    return reshape.spread_month(months, "month", ["gmv", "units_sold"])


def unpivot_pairs(spark, sf):
    pairs = {m: (f"{m}_units", f"{m}_revenue") for m in ch.WIDE_MONTHS}
    return reshape.unpivot_pairs(
        table(spark, sf, "in_wide_months"), ["sku_code"], pairs, ["units", "revenue"]
    )


def cutover_union(spark, sf):
    return ch.mt_ba_feed(table(spark, sf, "in_wide_months"), table(spark, sf, "in_daily_sheet"))


def discounted_sales(spark, sf):
    return discounted_feed(table(spark, sf, "in_sale"), table(spark, sf, "in_discounts")).select(
        "o_orderkey", "l_linenumber", *DISCOUNT_KEYS, "gmv", "gross_sale", "gross_sales"
    )


def group_having_window(spark, sf):
    """Lines of orders that have at least one line that is not a credit."""
    return reshape.exclude_groups(
        table(spark, sf, "in_salon"), "order_id", ~F.lower("ordertype").like("%credit%")
    )


QUERIES = {
    "channel_sales": channel_sales,
    "sales_union": sales_union,
    "spread_month": spread_month,
    "unpivot_pairs": unpivot_pairs,
    "cutover_union": cutover_union,
    "discounted_sales": discounted_sales,
    "group_having_window": group_having_window,
}


def dec(x: str) -> str:
    return f"CAST({x} AS DECIMAL(28,6))"


def total(x: str) -> str:
    return f"CAST(sum({dec(x)}) AS DOUBLE)"


_WIDE = " UNION ALL ".join(
    f"SELECT sku_code, '{m}' AS month, DATE '{2025 + i // 12}-{i % 12 + 1:02d}-01' AS first, "
    f"CAST({m}_units AS DOUBLE) AS units, CAST({m}_revenue AS DOUBLE) AS revenue FROM in_wide_months"
    for i, m in enumerate(ch.WIDE_MONTHS)
)
_DAYS = "unnest(generate_series({0}, last_day({0}), INTERVAL '1' DAY))"
_MTBA = f"""
    SELECT CAST(day AS DATE) AS order_date, product_id, gmv / d AS gmv, gross_sales / d AS gross_sales, units_sold / d AS units_sold FROM (
      SELECT {_DAYS.format('first')} AS day, day(last_day(first)) AS d, * FROM (
        SELECT CAST(sku_code AS STRING) AS product_id, first, sum(revenue) AS gmv, sum(units) AS units_sold,
          CAST({dec('sum(revenue)')} * 0.6000 AS DOUBLE) AS gross_sales
        FROM ({_WIDE}) WHERE units IS NOT NULL OR revenue IS NOT NULL GROUP BY 1, 2))
    UNION ALL
    SELECT CAST(date AS DATE), CAST(sku AS STRING), gmv_mrp_qty_, gross_sales, qty FROM in_daily_sheet
    WHERE CAST(date AS DATE) >= DATE '2026-05-01'"""

_NUM = "coalesce(CASE WHEN isnan(TRY_CAST({0} AS DOUBLE)) THEN NULL ELSE TRY_CAST({0} AS DOUBLE) END, 0)"
_INT = "CASE WHEN regexp_full_match({0}, '[0-9]+') THEN CAST({0} AS BIGINT) END"
_SOLD = "order_status IN ('Shipped', 'Pending')"


def branch(label, src, gmv, sale, units, where="TRUE", map="mm", guard="TRUE", inner=False,
           key="product_id", mult=None, smult=None, factor=None, cat="main_category", region="'null'",
           date="order_date", monthly=False):
    """One branch, aggregated per day and product before the mapping join."""
    brand, kind, channel, com = label
    g, s = ("CAST({0} AS DOUBLE)".format(x) for x in ("g", "s"))
    g = f"{g} * {mult}" if mult else g
    s = f"{s} * {smult}" if smult else s
    s = f"CAST({dec(s)} * {factor} AS DOUBLE)" if factor else s
    day = f"CAST(date_trunc('month', {date}) AS DATE)" if monthly else date
    out = f"""
      SELECT '{brand}' AS brand, '{com}' AS com, '{kind}' AS source_channel, '{channel}' AS channel, d, k, parent_sku,
        master_sku, product_title, master_title, mrp_og, {cat} AS main_category, sub_category, r AS region,
        {total(g)} AS gmv, {total(s)} AS gross_sales, CAST(sum(u) AS DOUBLE) AS units_sold
      FROM (SELECT {day} AS d, {key} AS k, {region} AS r, sum({dec(gmv)}) AS g, sum({dec(sale)}) AS s, sum({dec(units)}) AS u
            FROM {src} WHERE {where} GROUP BY ALL)
      {'' if inner else 'LEFT'} JOIN (SELECT * FROM {map} WHERE {guard}) ON k = map_key GROUP BY ALL"""
    if monthly:
        out = f"""SELECT brand, com, source_channel, channel, CAST(day AS DATE) AS d, k, parent_sku, master_sku, product_title,
          master_title, mrp_og, main_category, sub_category, region, gmv / n AS gmv, gross_sales / n AS gross_sales,
          units_sold / n AS units_sold
        FROM (SELECT {_DAYS.format('d')} AS day, day(last_day(d)) AS n, * FROM ({out}))"""
    return out


def _pri(feed: str) -> str:
    return "o_orderpriority = '" + next(p for p, fs in PRIORITY.items() if feed in fs) + "'"


def _m(channel, com="E-Com"):
    return ("FIRST", "Marketplace", channel, com)


def _o(channel):
    return ("FIRST", "Offline", channel, channel)


_FILL = "coalesce(main_category, 'Not filled')"
_FIX = "CASE WHEN lower({0}) = 'skincare' THEN 'Skin Care' ELSE {0} END"


def _b(channel, feed, gmv, sale, units, where="TRUE", com="E-Com", mult=None):
    return branch(("SECOND", "Marketplace", channel, com), "in_sale", gmv, sale, units, f"{_pri(feed)} AND {where}",
                  "mk", f"map_channel = '{channel}'", True, "CAST(product_id AS STRING)", mult, cat=_FIX.format("main_category"))


_SHOP = dict(gmv="item_gmv", sale="item_gross_revenue", units="item_quantity")
BRANCHES = [
    branch(_m("FK Minutes", "Q-Com"), "in_sale", "gmv", "gross_sales", _INT.format("units_text"), _pri("fk_minutes"),
           guard="lower(map_channel) = 'flipkart'", inner=True),
    branch(_m("Big Basket", "Q-Com"), "in_sale", "total_quantity * total_mrp", "total_sales", "total_quantity",
           _pri("big_basket") + " AND brand = 'Acme'"),
    *[branch(_m(c, "Q-Com"), "in_sale", _NUM.format("off_mrp"), _NUM.format("off_sp"), _NUM.format("off_qty"),
             f"{_pri(f)} AND {w}", cat=k)
      for c, f, w, k in [("Zepto", "zepto", "brand = 'Acme'", "main_category"),
                         ("Instamart", "instamart", "lower(brand) = 'acme'", _FILL),
                         ("Blinkit", "blinkit", "brand = 'Acme'", "main_category")]],
    branch(_m("First Cry"), "in_sale", "gmv", "gross_sales", "units_sold", _pri("first_cry") + " AND brand = 'ACME'", monthly=True),
    branch(_m("Smytten"), "in_sale", "gmv", "gross_sales", "units_sold", _pri("smytten")),
    branch(_m("Flipkart"), "in_sale", "gross_units", "gmv", "gross_units", _pri("flipkart") + " AND brand = 'Acme'", mult="mrp_og"),
    branch(_m("Myntra"), "in_sale", "item_mrp", "item_mrp - vendor_funding", "qty", _pri("myntra")),
    branch(_m("Purplle"), "in_sale", "gmv", "gross_sale", "units_sold", _pri("purplle")),
    branch(_m("Nykaa"), "in_sale", "mrp", "display_price", "total_qty", _pri("nykaa") + " AND brand = 'Acme'",
           guard="map_channel = 'Nykaa'"),
    branch(_m("Amazon"), "in_sale", "quantity", "item_price", "quantity",
           f"{_pri('amazon')} AND {_SOLD} AND lower(product_name) NOT LIKE '%zeta%'", guard="map_channel = 'Amazon'", mult="mrp_og"),
    branch(_m("Amazon"), "in_sale", "orderedunits", "orderedunits", "orderedunits", _pri("amazon_reseller"),
           guard="map_channel = 'Amazon'", mult="mrp_rev", smult="mrp_rev", factor="0.7700"),
    branch(_m("Tira"), "priced", "gmv", "sale", "units_sold", _pri("tira")),
    branch(_m("Meesho"), "in_sale", "quantity", "gross_sale", "quantity", _pri("meesho"), guard="map_channel = 'Meesho'", mult="mrp_og"),
    branch(("FIRST", "D2C", "Shopify", "Shopify"), "in_sale", **_SHOP, where=_pri("shop") + " AND is_cancelled = 0", cat=_FILL),
    branch(_o("GT_BA"), "in_sale", "sale_value", "sale_value", "quantity",
           _pri("gt_ba") + " AND sub_type IN ('GT-BA', 'GT-RBA') AND client_type = 'Retailer-BA'", "off", factor="0.7400"),
    branch(_o("MT_BA"), "mtba", "gmv", "gross_sales", "units_sold", map="off"),
    branch(_o("GT_NBA"), "(SELECT * FROM in_sale JOIN (SELECT CAST(product_id AS STRING) AS pid, vsku_code FROM in_listing) ON pid = product_id UNION ALL "
           "SELECT *, NULL, NULL FROM in_sale WHERE product_id NOT IN (SELECT CAST(product_id AS STRING) FROM in_listing))",
           "totalordervaluemrp", "totalordervaluemrp", "totalquantitysale",
           _pri("gt_nba") + " AND client_type = 'Retailer-NBA'", "off", factor="0.6640", key="vsku_code"),
    branch(_o("MT_CORE"), """(SELECT CAST(invoice_date AS DATE) AS order_date, replace(trim(component_sku), '`', '') AS product_id, *
             EXCLUDE (invoice_date) FROM in_po LEFT JOIN in_invoices ON trim(po_no) = trim(mp_ref_no) WHERE channel <> 'Other')""",
           "component_sku_mrp * item_quantity", "component_sku_mrp * item_quantity", "item_quantity", "TRUE", "off", factor="0.4440"),
    branch(_o("SALON"), """(SELECT CAST(strptime(order_date, '%d/%m/%Y %I:%M:%S %p') AS DATE) AS od,
             regexp_replace(product_id, '\\.0$', '') AS pid, * FROM in_salon
             WHERE client_type = 'Salon' AND lower(client_name) NOT LIKE '%dummy%' AND lower(ordertype) NOT LIKE '%credit%')""",
           _INT.format("grossamount"), _INT.format("order_amt"), _INT.format("quantity"), map="salon", key="pid", date="od", region="empzone"),
    branch(_o("EBO"), "(SELECT regexp_replace(product_id, '\\.0$', '') AS pid, * FROM in_sale_float_id)", "sale_value", "sale_value",
           "quantity", _pri("ebo") + " AND division = 'EBO'", guard="map_channel = 'EBO'", key="pid", factor="0.6500"),
    branch(_o("Export"), "(SELECT regexp_replace(product_id, '\\.0$', '') AS pid, * FROM in_sale_float_id)", "quantity", "sale_value",
           "quantity", _pri("export") + " AND brand = 'ACME'", map="exp", key="pid", mult="mrp_og", cat=_FILL, monthly=True),
    _b("Amazon", "b_amazon", "quantity", "item_price", "quantity", _SOLD, mult="mrp_og"),
    _b("Flipkart", "b_flipkart", "gross_units", "gmv", "gross_units", mult="mrp_og"),
    _b("Nykaa", "b_nykaa", "mrp", "display_price", "total_qty", "lower(brand) = 'acme'"),
    _b("Myntra", "b_myntra", "item_mrp", "item_mrp - vendor_funding", "qty"),
    _b("Blinkit", "b_blinkit", "mrp_gmv", "mrp_gmv - total_brand_fund", "qty_sold", com="Q-Com"),
    _b("Purplle", "b_purplle", "mrp", "gross_sales", "NULL"),
    _b("Instamart", "b_instamart", "gmv", "gmv - discount_spend", "units_sold", com="Q-Com"),
    branch(("SECOND", "D2C", "Shopify", "Shopify"), "in_sale", **_SHOP, where=_pri("b_shop") + " AND is_cancelled = 0",
           cat=_FIX.format(_FILL)),
]
_PRICED = """
    SELECT s.*, CASE WHEN s.order_date >= DATE '1998-01-01' THEN s.gross_sale ELSE s.gmv * (1 - coalesce(d.discount, 0)) END AS sale
    FROM in_sale s LEFT JOIN in_discounts d USING (order_date, product_id, customer_order_source)"""
MAPS = {
    "mm": """SELECT variant_id AS map_key, channel AS map_channel, parent_sku, master_sku, product_title, master_title, mrp_og,
      mrp_rev, main_category, sub_category FROM in_master_map""",
    "salon": """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY map_key ORDER BY
      CASE WHEN map_channel = 'Salon' THEN 0 ELSE 1 END, map_channel, parent_sku, master_sku, product_title) AS rn FROM mm) WHERE rn = 1""",
    "off": """SELECT sku AS map_key, NULL AS map_channel, sku AS parent_sku, NULL AS master_sku, product_name AS product_title,
      master_title, TRY_CAST(mrp AS DOUBLE) AS mrp_og, main_category, sub_category FROM (SELECT *, row_number() OVER (
      PARTITION BY sku ORDER BY product_name) AS rn FROM in_offline_map) WHERE rn = 1""",
    "exp": """SELECT product_id AS map_key, NULL AS map_channel, * EXCLUDE (product_id, division, mrp), TRY_CAST(mrp AS DOUBLE) AS mrp_og
      FROM in_export_map WHERE lower(division) LIKE '%export%'""",
    "mk": """SELECT identifier AS map_key, channel AS map_channel, sku AS parent_sku, main_sku AS master_sku,
      product_name AS product_title, product_name AS master_title, mrp AS mrp_og, category AS main_category,
      'null' AS sub_category FROM in_marketplace_map""",
    "priced": _PRICED,
    "mtba": _MTBA,
}
_MAPS = "WITH " + ", ".join(f"{n} AS ({q})" for n, q in MAPS.items())
_ALL = " UNION ALL ".join(f"(SELECT * FROM ({b}))" for b in BRANCHES)
FACT = f"""{_MAPS}, fact AS (
  SELECT brand, com, source_channel, channel, d AS order_date, parent_sku, product_title, master_title, main_category,
    sub_category, region, coalesce({total('gmv')}, 0) AS gmv, coalesce({total('gross_sales')}, 0) AS gross_sales,
    coalesce({total('units_sold')}, 0) AS units_sold
  FROM ({_ALL}) WHERE d < DATE '2026-06-01' GROUP BY ALL)"""

ORACLE = {
    "channel_sales": oracle(f"""{_MAPS} SELECT brand, source_channel, channel, com, d AS order_date, k AS product_id, parent_sku,
        master_sku, product_title, master_title, mrp_og, main_category, sub_category, region, gmv, gross_sales, units_sold FROM (
        {branch(_m("Amazon"), "in_sale", "quantity", "item_price", "quantity", f"{_SOLD} AND lower(product_name) NOT LIKE '%zeta%'",
                guard="map_channel = 'Amazon'", mult="mrp_og")})"""),
    "sales_union": oracle(FACT + " SELECT * FROM fact"),
    "spread_month": oracle(f"""
        SELECT month, brand, CAST(unnest(generate_series(month, last_day(month), INTERVAL '1' DAY)) AS DATE) AS order_date,
          gmv / day(last_day(month)) AS gmv, units_sold / day(last_day(month)) AS units_sold
        FROM (SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, brand, {total('gmv')} AS gmv,
          {total('units_sold')} AS units_sold FROM in_sale GROUP BY 1, 2)"""),
    "unpivot_pairs": oracle(
        f"SELECT sku_code, month, units, revenue FROM ({_WIDE}) WHERE units IS NOT NULL OR revenue IS NOT NULL"
    ),
    "cutover_union": oracle(_MTBA),
    "discounted_sales": oracle(f"""
        SELECT o_orderkey, l_linenumber, order_date, product_id, customer_order_source, gmv, gross_sale, sale AS gross_sales
        FROM ({_PRICED})"""),
    "group_having_window": oracle("""
        SELECT * EXCLUDE (n) FROM (SELECT *, count(*) FILTER (lower(ordertype) NOT LIKE '%credit%') OVER (PARTITION BY order_id) AS n
          FROM in_salon) WHERE n > 0"""),
}
