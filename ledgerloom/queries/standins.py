"""The given tables in the shapes the operators expect.

Each stand-in is one SELECT that Spark and DuckDB read alike: Spark gets it over DataFrames,
the check gets it as a common table expression.  The operators themselves are written twice,
once in the library and once as SQL in the query modules.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "pages",
    "conversations",
]

STANDINS: dict[str, str] = {
    # product catalogue: kits, giveaways, low-tax titles, and SKUs that are not known
    "in_products": """
        SELECT p_partkey, CAST(p_partkey AS STRING) AS variant_id,
               CASE WHEN p_brand = 'Brand#7' THEN NULL
                    WHEN p_brand = 'Brand#1' THEN 'SAM-' || p_partkey
                    WHEN p_size <= 2 THEN 'PG-MINI-' || p_partkey
                    ELSE 'SKU-' || p_partkey END AS parent_sku,
               'M-' || p_partkey AS master_sku, p_name AS product_title,
               CASE WHEN p_name LIKE '%anvil' THEN p_name || ' Hair Oil'
                    WHEN p_name LIKE 'old%' THEN p_name || ' Pouch'
                    WHEN p_name LIKE 'new%' THEN NULL ELSE p_name END AS master_title,
               CASE WHEN p_type = 'SMALL' THEN 'Shampoo' ELSE p_type END AS sub_category,
               CASE WHEN p_brand = 'Brand#9' THEN NULL ELSE p_brand END AS main_category,
               CASE WHEN p_size > 40 THEN 'Combo' WHEN p_size > 35 THEN 'PhysicalKit'
                    ELSE 'Single' END AS type_of_product,
               p_retailprice AS mrp
        FROM {part}""",
    "in_shop_lines": """
        SELECT 'S' || l_orderkey AS order_name, l_orderkey * 10 + l_linenumber AS order_item_id,
               o_orderdate AS order_created_at,
               CASE WHEN l_quantity < 5 THEN NULL WHEN l_quantity < 8 THEN ' '
                    WHEN l_linestatus = 'F' THEN 'fulfilled' WHEN l_quantity < 20 THEN 'partial'
                    WHEN l_quantity < 30 THEN 'unknown' ELSE 'open' END AS order_fulfillment_status,
               CASE WHEN o_orderstatus = 'F' THEN 'paid' ELSE 'pending' END AS order_financial_status,
               CASE WHEN o_orderstatus = 'P' THEN 1 WHEN o_orderpriority = '5-LOW' THEN NULL
                    ELSE 0 END AS is_cancelled,
               parent_sku, master_title, sub_category, variant_id AS item_variant_id,
               l_quantity AS item_quantity, mrp AS item_mrp_price,
               mrp * l_quantity AS item_gmv, l_extendedprice AS item_gross_revenue
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
        JOIN {in_products} ON l_partkey = p_partkey""",
    "in_erp_lines": """
        SELECT 'S' || l_orderkey AS order_number, '`' || (l_orderkey * 10 + l_linenumber) AS suborder_no,
               'K' || l_linenumber AS sku,
               CASE WHEN l_quantity < 3 THEN 'nan' WHEN l_quantity < 5 THEN ''
                    WHEN l_quantity < 7 THEN NULL
                    WHEN l_linestatus = 'O' THEN '`A' || l_orderkey || '-' || l_suppkey
                    ELSE 'A' || l_orderkey || '-' || l_suppkey END AS awb_no,
               CASE WHEN l_linenumber = 7 THEN NULL ELSE '"BOX' || l_linenumber || '"' END
                   AS packing_material,
               CAST(p_size AS DOUBLE) AS product_weight, l_quantity AS suborder_quantity,
               CASE WHEN o_orderstatus = 'O' THEN 'ACME' ELSE 'Acme' END AS brand,
               CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'COD' ELSE 'Prepaid' END
                   AS payment_mode,
               o_totalprice AS order_invoice_amount,
               CASE WHEN o_orderpriority = '5-LOW' THEN 'Shop1' ELSE 'Shop' END AS mp_name,
               CASE WHEN l_quantity = 10 THEN 'nan' WHEN l_quantity = 11 THEN 'x'
                    WHEN l_discount = 0.05 THEN CAST(l_extendedprice - 40 AS STRING)
                    ELSE CAST(l_extendedprice AS STRING) END AS selling_price,
               CAST(l_shipdate AS DATE) AS invoice_date,
               o_orderdate + (l_linenumber * 3) * INTERVAL '1' HOUR AS order_date,
               CASE WHEN l_returnflag = 'R' AND l_quantity > 40 THEN 'Returned'
                    WHEN l_quantity > 35 THEN 'Ready to Dispatch' WHEN l_quantity > 30 THEN 'CANCELLED'
                    WHEN l_quantity > 25 THEN 'Printed' WHEN l_quantity > 22 THEN 'Lost in Hub'
                    ELSE 'Shipped' END AS order_status,
               CASE WHEN l_tax < 0.02 THEN 'Shipment Created' WHEN l_tax < 0.04 THEN 'Picked Up'
                    WHEN l_tax < 0.06 THEN 'Delivered' WHEN l_tax < 0.07 THEN NULL
                    ELSE 'In Process' END AS shipping_status,
               'WH' || (l_suppkey % 5) AS client_location, 'INV' || l_orderkey AS ee_invoice_no,
               l_shipdate + (l_linenumber * 5) * INTERVAL '1' HOUR AS ee_extracted_at,
               l_partkey, l_suppkey, l_extendedprice
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {part} ON l_partkey = p_partkey""",
    # courier feed: repeated (order, AWB) rows, unknown and excluded couriers
    "in_tracking": """
        SELECT 'S' || l_orderkey AS order_id, 'A' || l_orderkey || '-' || l_suppkey AS awb,
               CAST(o_orderdate AS DATE) AS order_date,
               CASE l_suppkey % 9 WHEN 0 THEN 'Delhivery' WHEN 1 THEN 'Shiprocket'
                    WHEN 2 THEN 'Elastic Run B2C' WHEN 3 THEN 'Pikndel HLD' WHEN 4 THEN 'XpressBees'
                    WHEN 5 THEN 'PicoXpress' WHEN 6 THEN '' WHEN 7 THEN NULL
                    ELSE 'Somebody' END AS courier_partner,
               CASE WHEN l_returnflag = 'R' AND l_quantity > 45 THEN 'RTO-Delivered'
                    WHEN l_returnflag = 'N' AND l_quantity > 48 THEN 'Lost'
                    WHEN l_returnflag = 'N' AND l_quantity > 44 THEN 'Damaged'
                    WHEN l_returnflag = 'N' AND l_quantity > 40 THEN 'ShipmentDelayed'
                    WHEN l_returnflag = 'N' AND l_quantity > 36 THEN 'PickupPending'
                    WHEN l_returnflag = 'N' AND l_quantity > 32 THEN 'FailedDelivery'
                    WHEN l_returnflag = 'N' AND l_quantity > 28 THEN 'InTransit'
                    WHEN l_returnflag = 'N' AND l_quantity > 26 THEN 'Cancelled'
                    WHEN l_returnflag = 'N' AND l_quantity > 24 THEN 'RTO-InTransit'
                    WHEN l_returnflag = 'N' AND l_quantity > 22 THEN 'Somewhere'
                    ELSE 'Delivered' END AS clickpost_unified_status,
               CAST(110000 + s_nationkey AS STRING) AS pickup_pincode,
               CAST(110000 + c_nationkey AS STRING) AS drop_pincode,
               CASE WHEN l_returnflag = 'R' AND l_quantity > 45 THEN l_shipdate END AS rto_delivery_date,
               l_shipdate + l_linenumber * INTERVAL '1' HOUR AS ingestion_date,
               l_extendedprice AS invoice_value, l_partkey, l_linenumber
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
        JOIN {customer} ON o_custkey = c_custkey JOIN {supplier} ON l_suppkey = s_suppkey""",
}

# small cards that stay the same at every scale
CARDS: dict[str, str] = {
    "in_boxes": """
        SELECT packaging_sku, CAST(volume_weight_gram AS DOUBLE) AS volume_weight_gram, CAST(length_cm_ AS DOUBLE) AS length_cm_,
          CAST(width_cm AS DOUBLE) AS width_cm, CAST(height_cm AS DOUBLE) AS height_cm, CAST(dead_weight AS DOUBLE) AS dead_weight
        FROM (VALUES ('BOX1', 200.0, 10.0, 10.0, 10.0, 20.0), ('BOX2', 450.0, 12.0, 11.0, 17.0, 35.0),
          ('BOX3', 900.0, 20.0, 15.0, 15.0, 60.0), ('BOX4', NULL, NULL, NULL, NULL, 80.0),
          ('BOX5', 2400.0, 30.0, 20.0, 20.0, NULL))
          AS t(packaging_sku, volume_weight_gram, length_cm_, width_cm, height_cm, dead_weight)""",
    "in_rate_card": """
        SELECT partner, charge_type, weight_slab_grams, CAST(zone_a AS DOUBLE) AS zone_a, CAST(zone_b AS DOUBLE) AS zone_b,
          CAST(zone_c AS DOUBLE) AS zone_c, CAST(zone_d AS DOUBLE) AS zone_d, CAST(zone_ef AS DOUBLE) AS zone_ef,
          CAST(cod_flat AS DOUBLE) AS cod_flat, CAST(cod_pct AS DOUBLE) AS cod_pct
        FROM (VALUES
          ('Delhivery', 'Forward', 250, 30.0, 35.0, 40.0, 45.0, 60.0, 25.0, 0.015),
          ('Delhivery', 'Forward', 500, 38.0, 43.0, 48.0, 55.0, 75.0, 25.0, 0.015),
          ('Delhivery', 'Forward', 501, 20.0, 22.0, 25.0, 28.0, 36.0, NULL, NULL),
          ('Delhivery', 'RTO', 250, 28.0, 31.0, 36.0, 40.0, 52.0, NULL, NULL),
          ('Delhivery', 'RTO', 500, 34.0, 39.0, 44.0, 49.0, 66.0, NULL, NULL),
          ('Delhivery', 'RTO', 501, 18.0, 20.0, 22.0, 25.0, 32.0, NULL, NULL),
          ('Shiprocket', 'Forward', 250, 33.0, 37.0, 41.0, 46.0, 62.0, 30.0, 0.02),
          ('Shiprocket', 'Forward', 500, 41.0, 46.0, 52.0, 57.0, 78.0, 30.0, 0.02),
          ('Shiprocket', 'RTO', 500, 36.0, 40.0, 45.0, 50.0, 68.0, NULL, NULL),
          ('Elastic Run', 'Forward', 250, 27.0, NULL, NULL, NULL, NULL, 20.0, 0.01),
          ('Elastic Run', 'Forward', 501, 15.0, NULL, NULL, NULL, NULL, NULL, NULL),
          ('Elastic Run', 'RTO', 501, 12.0, NULL, NULL, NULL, NULL, NULL, NULL),
          ('Xpressbee', 'Forward', 500, 39.0, 44.0, 49.0, 56.0, 76.0, 24.0, 0.018),
          ('Xpressbee', 'Forward', 501, 21.0, 23.0, 26.0, 29.0, 37.0, NULL, NULL))
          AS t(partner, charge_type, weight_slab_grams, zone_a, zone_b, zone_c, zone_d, zone_ef, cod_flat, cod_pct)""",
    "in_zone_map": """
        SELECT (110000 + a.n_nationkey) || '-' || (110000 + b.n_nationkey) AS sd_pincode, t.partner,
               CASE WHEN a.n_nationkey = b.n_nationkey THEN 'A' WHEN a.n_regionkey = b.n_regionkey THEN 'B'
                    WHEN a.n_regionkey < b.n_regionkey THEN 'C1' WHEN b.n_regionkey = 0 THEN 'D2'
                    WHEN b.n_regionkey = 1 THEN 'E' ELSE 'Z' END AS delivery_zone
        FROM {nation} a CROSS JOIN {nation} b
        CROSS JOIN (VALUES ('Delhivery'), ('Shiprocket'), ('Xpressbee')) AS t(partner)""",
}
STANDINS.update(CARDS)


def register(more: dict[str, str]) -> None:
    STANDINS.update(more)


_plans: WeakKeyDictionary[SparkSession, dict[tuple[str, str], DataFrame]] = WeakKeyDictionary()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table or a stand-in; its plan is built once per session."""
    plans = _plans.setdefault(spark, {})
    if (sf_dir, name) not in plans:
        plans[sf_dir, name] = _table(spark, sf_dir, name)
    return plans[sf_dir, name]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in STANDINS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return _select(spark, STANDINS[name], lambda t: table(spark, sf_dir, t))


def _select(spark: SparkSession, sql: str, source: Callable[[str], DataFrame]) -> DataFrame:
    used = set(re.findall(r"\{(\w+)\}", sql))
    return spark.sql(sql, **{t: source(t) for t in used}) if used else spark.sql(sql)


# How stand-ins name the lines with their orders, and the columns of the two that they read.
ORDER_LINES = "{lineitem} JOIN {orders} ON l_orderkey = o_orderkey"
LINE_COLUMNS = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate", "o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority",
]


def over_lines(spark: SparkSession, sf_dir: str, lines: DataFrame) -> Callable[[str], DataFrame]:
    """Like :func:`table`, but stand-ins read ``lines`` where they name :data:`ORDER_LINES`.

    ``lines`` is that join, written once: it has the few columns that the stand-ins are made from, not
    the many that they make.
    """
    made: dict[str, DataFrame] = {}

    def source(name: str) -> DataFrame:
        if name == "lines":
            return lines
        if name not in made:
            sql = STANDINS.get(name)
            made[name] = table(spark, sf_dir, name) if sql is None else _select(spark, sql.replace(ORDER_LINES, "{lines}"), source)
        return made[name]

    return source


def order_lines(spark: SparkSession, sf_dir: str, columns: list[str] = LINE_COLUMNS) -> DataFrame:
    """Lines joined with their orders."""
    return _select(spark, f"SELECT {', '.join(columns)} FROM {ORDER_LINES}", lambda t: table(spark, sf_dir, t))


def oracle(sql: str) -> str:
    """SQL with the stand-ins it names put before it."""
    order: list[str] = []

    def need(text: str) -> None:
        for name in re.findall(r"\bin_\w+", text):
            if name in STANDINS and name not in order:
                need(STANDINS[name])
                if name not in order:
                    order.append(name)

    need(sql)
    if not order:
        return sql.strip()
    ctes = ",\n".join(f"{n} AS ({re.sub(r'[{](\w+)[}]', r'\1', STANDINS[n]).strip()})" for n in order)
    body = sql.strip()
    text = f"WITH {ctes},\n{body[5:]}" if body[:5].upper() == "WITH " else f"WITH {ctes}\n{body}"
    _unique_steps(text)
    return text


def _unique_steps(sql: str) -> None:
    """Raise if two steps of the top-level WITH list share a name (DuckDB refuses them only when run)."""
    names = re.findall(r"(?:^WITH\s+|,\s*\n?\s*)(\w+)\s+AS\s+\(", sql, flags=re.IGNORECASE)
    repeated = sorted({n for n in names if names.count(n) > 1})
    if repeated:
        raise ValueError(f"repeated step names in the SQL: {', '.join(repeated)}")
