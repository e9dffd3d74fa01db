"""Cleaning and deduplication."""

from pyspark.sql import functions as F

from ..functions import ids, numbers, status
from ..operators import dedupe
from .standins import oracle, register, table

register(
    {
        "in_raw_ids": """
            SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
                   CASE l_linenumber WHEN 1 THEN '`' || l_orderkey WHEN 2 THEN '"' || l_orderkey || '"'
                        WHEN 3 THEN l_orderkey || '.0' WHEN 4 THEN 'nan' WHEN 5 THEN '   '
                        WHEN 6 THEN NULL ELSE '12345678' || (1000000 + l_orderkey) END AS raw_id,
                   CASE l_linenumber WHEN 1 THEN CAST(l_quantity AS STRING) WHEN 2 THEN 'nan'
                        WHEN 3 THEN 'x' WHEN 4 THEN NULL WHEN 5 THEN CAST(l_partkey AS STRING)
                        WHEN 6 THEN '' ELSE CAST(l_extendedprice AS STRING) END AS raw_number,
                   CASE WHEN l_quantity < 3 THEN NULL WHEN l_quantity < 8 THEN 'Awb-Registered'
                        WHEN l_quantity < 13 THEN 'PickedUp' WHEN l_quantity < 18 THEN 'in-transit'
                        WHEN l_quantity < 23 THEN 'OutForDelivery' WHEN l_quantity < 28 THEN 'Delivered'
                        WHEN l_quantity < 33 THEN 'RTO-Delivered' WHEN l_quantity < 38 THEN 'failed delivery'
                        WHEN l_quantity < 43 THEN 'Lost' ELSE 'Held-Up' END AS raw_status
            FROM {lineitem}""",
        "in_channel_products": """
            SELECT l_partkey AS variant_id, CASE WHEN l_returnflag = 'R' THEN 'Salon' ELSE l_linestatus END AS channel,
                   l_suppkey AS parent_sku, l_orderkey AS master_sku, l_linenumber AS pos
            FROM {lineitem}""",
    }
)

KEYS = ["l_orderkey", "l_linenumber"]
TIES = ["l_partkey", "l_suppkey", "l_extendedprice"]


def dedupe_latest(spark, sf):
    return dedupe.dedupe_latest(table(spark, sf, "lineitem"), KEYS, "l_shipdate", TIES)


def dedupe_first(spark, sf):
    return dedupe.dedupe_first(table(spark, sf, "lineitem"), KEYS, "l_shipdate", TIES)


def dedupe_any(spark, sf):
    return dedupe.dedupe_any(table(spark, sf, "lineitem"), KEYS, TIES)


def pick_preferred(spark, sf):
    return dedupe.pick_preferred(
        table(spark, sf, "in_channel_products"),
        ["variant_id"],
        F.col("channel") == "Salon",
        ["channel", "parent_sku", "master_sku", "pos"],
    )


def _ids(spark, sf, **columns):
    keep = [*KEYS, *TIES]
    return table(spark, sf, "in_raw_ids").select(*keep, *[c.alias(n) for n, c in columns.items()])


def clean_id(spark, sf):
    return _ids(spark, sf, id=ids.clean_id("raw_id"))


def pad_id(spark, sf):
    return _ids(
        spark, sf, padded=ids.pad_id("raw_id"),
        length=F.length(ids.pad_id(ids.clean_id("raw_id"))).cast("bigint"),
    )


def safe_number(spark, sf):
    return _ids(
        spark, sf,
        as_double=numbers.safe_number("raw_number"),
        as_double_or_0=numbers.safe_number("raw_number", default=0),
        as_int=numbers.safe_number("raw_number", "bigint"),
    )


def unify_status(spark, sf):
    return _ids(spark, sf, status=status.unify_status("raw_status", status.COURIER_STATUS))


QUERIES = {
    "dedupe_latest": dedupe_latest,
    "dedupe_first": dedupe_first,
    "dedupe_any": dedupe_any,
    "pick_preferred": pick_preferred,
    "clean_id": clean_id,
    "pad_id": pad_id,
    "safe_number": safe_number,
    "unify_status": unify_status,
}

_ONE = """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber ORDER BY {order} l_partkey, l_suppkey, l_extendedprice) AS rn
  FROM lineitem) WHERE rn = 1"""
_KEEP = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice"
_CLEAN = """CASE WHEN trim(regexp_replace(trim(replace(raw_id, '`', ''), '"'), '\\.0$', '')) IN ('', 'nan') THEN NULL
  ELSE regexp_replace(trim(replace(raw_id, '`', ''), '"'), '\\.0$', '') END"""

ORACLE = {
    "dedupe_latest": _ONE.format(order="l_shipdate DESC NULLS LAST,"),
    "dedupe_first": _ONE.format(order="l_shipdate ASC NULLS FIRST,"),
    "dedupe_any": _ONE.format(order=""),
    "pick_preferred": oracle("""
        SELECT variant_id, channel, parent_sku, master_sku, pos FROM (
          SELECT *, row_number() OVER (PARTITION BY variant_id ORDER BY
            CASE WHEN channel = 'Salon' THEN 0 ELSE 1 END, channel, parent_sku, master_sku, pos) AS rn
          FROM in_channel_products) WHERE rn = 1"""),
    "clean_id": oracle(f"SELECT {_KEEP}, {_CLEAN} AS id FROM in_raw_ids"),
    "pad_id": oracle(f"""
        SELECT {_KEEP}, CASE WHEN length(raw_id) >= 13 THEN substr(raw_id, 1, 13)
                             ELSE repeat('0', 13 - length(raw_id)) || raw_id END AS padded,
               CASE WHEN {_CLEAN} IS NULL THEN NULL ELSE CAST(13 AS BIGINT) END AS length
        FROM in_raw_ids"""),
    "safe_number": oracle(f"""
        SELECT {_KEEP}, v AS as_double, coalesce(v, 0) AS as_double_or_0,
               CASE WHEN regexp_full_match(raw_number, '[+-]?[0-9]+') THEN CAST(raw_number AS BIGINT) END AS as_int
        FROM (SELECT *, CASE WHEN isnan(TRY_CAST(raw_number AS DOUBLE)) THEN NULL
                             ELSE TRY_CAST(raw_number AS DOUBLE) END AS v FROM in_raw_ids)"""),
    "unify_status": oracle(f"""
        SELECT {_KEEP}, CASE replace(lower(raw_status), '-', ' ')
          WHEN 'awb registered' THEN 'Processing' WHEN 'pickedup' THEN 'Shipped'
          WHEN 'in transit' THEN 'In Transit' WHEN 'outfordelivery' THEN 'Out For Delivery'
          WHEN 'delivered' THEN 'Delivered' WHEN 'rto delivered' THEN 'Returned (RTO)'
          WHEN 'failed delivery' THEN 'Delivery Failed' WHEN 'lost' THEN 'Exception'
          ELSE raw_status END AS status
        FROM in_raw_ids"""),
}
