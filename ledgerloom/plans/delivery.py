"""Two shipment reports: by order (customer view) and by ERP shipment (warehouse view)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import clean_id, pad_id
from ..operators import tracking as t
from ..operators.dedupe import dedupe_any, dedupe_latest
from ..operators.joins import lookup

Order = Sequence[Column | str]


def tracking_report(
    tracking: DataFrame,
    tracking_history: DataFrame,
    shipping: DataFrame,
    orders: DataFrame,
    places: DataFrame,
    erp: DataFrame,
    addresses: DataFrame,
    warehouses: DataFrame,
    as_of: datetime,
    since: date,
    zone: str,
    channel: str,
    mode: str = "elapsed",
    tiebreak: Order = ("awb",),
) -> DataFrame:
    """One row per tracked order with lead times, promises, alerts and its warehouse.

    Orders after ``since`` only; ``created_at`` and the order date stay in UTC while the other
    times move to ``zone``.
    """
    padded = lambda df, c="order_id": df.withColumn(c, pad_id(c))
    base = dedupe_latest(padded(tracking), ["order_id"], "latest_timestamp", tiebreak)
    base = t.to_local(base, t.LOCAL_COLUMNS, zone)

    newest = dedupe_latest(padded(shipping), ["order_id"], "ingestion_date", tiebreak)
    newest = newest.select("order_id", "courier_partner", "carrier_via_aggregator", "clickpost_unified_status")
    ship = newest.join(t.concat_distinct(padded(shipping), ["order_id"], "awb"), "order_id", "left")
    om = dedupe_latest(padded(orders), ["order_id"], "ingestion_date", tiebreak)
    om = om.where(F.col("order_date") > F.lit(since))
    om = t.enrich_place(om, places, "drop_pincode", "pincode", ["state", "main_city"], ["main_city", "state"])
    om = om.select("order_id", "payment_mode", "drop_pincode", "order_date", "state", "main_city")
    status = dedupe_latest(
        padded(erp.where(F.col("mp_name") == channel), "order_number"),
        ["order_number"], "ee_extracted_at", ["order_status"],
    ).select(F.col("order_number").alias("order_id"), "order_status")

    d = base.join(om, "order_id")  # the date bound on the order makes this an inner join
    d = t.multi_shipment_tag(d, tracking_history)
    d = d.join(ship, "order_id", "left").join(status, "order_id", "left")
    d = t.lead_times(d, "order_date", "pickup_date", "delivery_date", mode)
    state = t.final_status(t.shipped_rules(), F.col("clickpost_unified_status"))
    label, order = t.ship_bucket("o2s_d", "final_status")
    d = d.withColumn("final_status", state).withColumns(
        {
            "tat": t.tat_class(),
            "delivery_delay_category": t.delay_class(),
            "delivered_day_count": F.col("o2d_d"),
            "alert_1_vs_2": t.reattempt_alert(mode=mode),
            "alert": t.pickup_alert("created_at", "pickup_date"),
            "o2s_bucket": label,
            "o2s_bucket_sort": order,
            "sla_breach": t.sla_breach("latest_timestamp", "final_status", as_of),
        }
    )
    wh = dedupe_any(warehouses, ["pincode_pickup"], ["wh_name", "city_pickup", "state_pickup"])
    from_wh = dedupe_latest(
        addresses.where(F.col("pickup_pincode").isNotNull()), ["order_id"], "ingestion_date",
        ["pickup_pincode"],
    ).select("order_id", clean_id("pickup_pincode", strip=(".0",), null_words=()).alias("pickup_pincode"))
    from_wh = lookup(
        from_wh, wh.withColumnRenamed("pincode_pickup", "pickup_pincode"), ["pickup_pincode"]
    )
    d = d.join(from_wh, "order_id", "left")  # addresses keep their ids unpadded
    columns = [
        "order_id", "created_at", "order_date", "pickup_date", "latest_timestamp", "latest_remark",
        "delivery_date", *t.PROMISES, *t.ATTEMPTS, "out_for_delivery_attempts",
        "reason_for_last_failed_delivery", "remark_of_last_failed_delivery", "ingestion_date",
        "courier_partner", "carrier_via_aggregator", "clickpost_unified_status", "awb_list",
        "payment_mode", "drop_pincode", "state", "main_city", "o2s", "s2d", "o2d", "o2s_d", "s2d_d",
        "o2d_d", "tat", "delivery_delay_category", "final_status", "delivered_day_count",
        "alert_1_vs_2", "alert", "o2s_bucket", "o2s_bucket_sort", "wh_name", "pickup_pincode",
        "city_pickup", "state_pickup", "sla_breach", "multiple_awb_tag",
    ]
    return d.select(*columns)


def warehouse_report(
    erp: DataFrame,
    credit_notes: DataFrame,
    tracking: DataFrame,
    shipping: DataFrame,
    since: date,
    zone: str,
    padded_store: str,
    raw_store: str,
    mode: str = "elapsed",
    erp_tiebreak: Order = ("order_status",),
    tiebreak: Order = (),
) -> DataFrame:
    """One row per ERP shipment of two stores with courier facts.

    ``tracking`` and ``shipping`` carry ``store``; one store's courier ids are padded, the
    other's are not.

    Each feed is dealt out once, by the key of its first join, for its deduplication and that join.
    Courier rows that lack a part of the key meet no shipment and are left out before.
    """
    e = erp.where(
        F.col("mp_name").isin(padded_store, raw_store) & (F.col("order_date") >= F.lit(since))
    )
    e = e.withColumns({"order_number_raw": F.col("order_number"), "order_number": pad_id("order_number")})
    e = dedupe_latest(
        e.repartition("order_number"), ["order_number", "order_number_raw", "awb_no"], "ee_extracted_at", erp_tiebreak
    )
    e = t.strip_and_join(e, credit_notes, ["creditnote_number"])

    def newest(df: DataFrame) -> DataFrame:
        key = F.when(F.col("store") == padded_store, pad_id("order_id")).otherwise(F.col("order_id"))
        keyed = df.withColumn("_padded", key).where("awb IS NOT NULL AND _padded IS NOT NULL AND store IS NOT NULL")
        dealt = keyed.repartition("awb", "_padded", "store")
        one = dedupe_latest(dealt, ["store", "order_id", "_padded", "awb"], "ingestion_date", tiebreak)
        return one.withColumn("order_id", F.col("_padded")).drop("_padded", "ingestion_date")

    facts = t.to_local(newest(tracking), t.LOCAL_COLUMNS, zone)
    ship = newest(shipping)
    routes = {
        padded_store: (F.col("order_number"), padded_store),
        raw_store: (F.col("order_number_raw"), raw_store),
    }
    d = t.routed_join(e, [ship, facts], routes, "mp_name", "order_id", "awb_no", "awb")
    d = t.lead_times(d, "created_at", "pickup_date", "delivery_date", mode)
    rules, rest = t.warehouse_rules()
    return d.withColumns(
        {
            "mismatch_rto": t.mismatch_rto(),
            "alert": t.pickup_alert("created_at", "pickup_date"),
            "final_status": t.final_status(rules, rest),
        }
    ).withColumnsRenamed({"client_location": "warehouse", "awb_no": "tracking_number"})
