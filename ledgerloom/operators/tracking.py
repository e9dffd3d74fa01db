"""Delivery tracking: lead times, promises kept, alerts and final states."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import clean_id, pad_id, spread_nulls
from ..functions.status import first_match
from ..functions.timing import days_between, hours_between, moment, to_zone
from .dedupe import dedupe_any, dedupe_latest
from .joins import lookup

# Statuses and labels.
NEVER_SENT = ["Returned", "Assigned", "Cancelled", "Printed", "CANCELLED", "Manifest Scanned"]
COURIER_STATES = {
    "Damaged": ["Damaged", "Lost"],
    "InTransit": ["DestinationHubIn", "InTransit", "OriginCityIn", "OriginCityOut"],
    "Pickup failed": ["PickupPending", "PickupFailed"],
}
MOVING_STATES = ["InTransit", "FailedDelivery", "OutForDelivery", "ShipmentDelayed"]
STUCK_ERP_STATES = ["returned", "assigned", "cancelled", "printed", "manifest scanned"]
ON_THE_WAY = ["intransit", "outfordelivery", "pickedup", "destinationhubin", "faileddelivery"]
IN_PACKING = ["confirmed", "manifest scanned", "pending", "printed", "ready to dispatch", "assigned"]
NOT_YET_PICKED = ["Awb Registered", "OrderPlaced", "OutForPickup", "PickupFailed", "PickupPending"]
LATE_LABELS = {1: "1_day_late", 2: "2_days_late", 3: "3_days_late", 4: "4_days_late"}
ATTEMPTS = [
    "out_for_delivery_1st_attempt", "out_for_delivery_2nd_attempt", "out_for_delivery_3rd_attempt",
    "out_for_delivery_4th_attempt", "out_for_delivery_5th_attempt",
]
PROMISES = [
    "expected_delivery_date_by_courier_partner", "expected_date_of_delivery_max",
    "expected_date_of_delivery_min",
]
LOCAL_COLUMNS = ["pickup_date", "latest_timestamp", "delivery_date", *PROMISES, *ATTEMPTS]


def to_local(df: DataFrame, cols: Sequence[str], zone: str) -> DataFrame:
    """UTC wall clock to that of ``zone`` for the named columns only."""
    return df.withColumns({c: to_zone(c, zone) for c in cols if c in df.columns})


def multi_shipment_tag(df: DataFrame, tracking: DataFrame, key: str = "order_id") -> DataFrame:
    """Add the number of distinct AWBs of the order and whether there are several."""
    counts = tracking.groupBy(pad_id(key).alias(key)).agg(F.countDistinct("awb").alias("awb_count"))
    count = F.coalesce("awb_count", F.lit(0).cast("bigint"))
    return (
        df.join(counts, key, "left")
        .withColumn("awb_count", count)
        .withColumn("multiple_awb_tag", (F.col("awb_count") > 1).cast("int"))
    )


def concat_distinct(
    df: DataFrame, keys: Sequence[Column | str], col: str, sep: str = ", ", out: str = "awb_list"
) -> DataFrame:
    """Distinct values of ``col`` per key as one sorted text.

    Repeats are removed by a grouping of their own, so only distinct values are collected.
    """
    pairs = df.select(*keys, F.col(col).alias("_v")).distinct()
    names = [c for c in pairs.columns if c != "_v"]
    return pairs.groupBy(*names).agg(
        F.expr(f"listagg(_v, '{sep}') within group (order by _v)").alias(out)
    )


def enrich_place(
    df: DataFrame, places: DataFrame, key: str, place_key: str, columns: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """Left lookup of place columns by a postal code that may carry a float suffix."""
    one = dedupe_any(places.where(F.col(place_key).isNotNull()), [place_key], order_by)
    one = one.select(F.col(place_key).cast("string").alias("_code"), *columns)
    code = clean_id(F.col(key).cast("string"), strip=(".0",), null_words=())
    return lookup(df.withColumn("_code", code), one, ["_code"]).drop("_code")


def routed_join(
    left: DataFrame,
    right: DataFrame | Sequence[DataFrame],
    routes: Mapping[str, tuple[Column, str]],
    route: str,
    right_order: str,
    left_extra: str,
    right_extra: str,
) -> DataFrame:
    """Left join whose key depends on the source of the row.

    ``routes`` maps a source to its key column and the marker of the store it may match.
    The choice is computed into one key first, so the join is an equi-join and never an OR.
    ``right`` has a column ``store`` with the marker; of several frames each is joined on that key,
    for one shuffle of ``left``.
    """
    key = first_match([(F.col(route) == r, k) for r, (k, _) in routes.items()])
    store = first_match([(F.col(route) == r, s) for r, (_, s) in routes.items()])
    joined = left.withColumns(
        {"_key": key, "_store": store, "_extra": spread_nulls(left_extra, key)}
    )
    for frame in [right] if isinstance(right, DataFrame) else right:
        lookup = frame.withColumnsRenamed(
            {right_order: "_r_key", "store": "_r_store", right_extra: "_r_extra"}
        )
        joined = joined.join(
            lookup,
            (F.col("_extra") == F.col("_r_extra"))
            & (F.col("_key") == F.col("_r_key"))
            & (F.col("_store") == F.col("_r_store")),
            "left",
        ).drop("_r_key", "_r_store", "_r_extra")
    return joined.drop("_key", "_store", "_extra")


def strip_and_join(df: DataFrame, credit_notes: DataFrame, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Add the newest credit note of the order.

    Its order number carries a leading backtick and no padding; both sides are padded.
    """
    cleaned = pad_id(clean_id("order_number", strip=("leading_backtick",), null_words=()))
    notes = credit_notes.withColumn("order_number", cleaned)
    notes = dedupe_latest(notes, ["order_number"], "ee_extracted_at", tiebreak)
    return df.join(notes.select("order_number", "creditnote_number"), "order_number", "left")


def lead_times(df: DataFrame, start: str, mid: str, end: str, mode: str = "elapsed") -> DataFrame:
    """Order to ship, ship to delivery and order to delivery, in 24-hour and calendar days."""
    spans = {"o2s": (mid, start), "s2d": (end, mid), "o2d": (end, start)}
    out = {}
    for name, (later, earlier) in spans.items():
        hours = hours_between(later, earlier, mode).cast("decimal(18,4)")
        out[name] = F.round(hours / F.lit(24).cast("decimal(4,0)"), 2).cast("double")
    for name, (later, earlier) in spans.items():
        out[f"{name}_d"] = days_between(later, earlier)
    return df.withColumns(out)


def tat_class(
    delivered: str = "delivery_date",
    attempted: str = ATTEMPTS[0],
    promised_cols: Sequence[str] = PROMISES,
) -> Column:
    """Delivery against the first promise there is."""
    promise = F.to_date(F.coalesce(*promised_cols))
    day = F.to_date(delivered)
    return first_match(
        [
            (F.col(delivered).isNull(), "others"),
            (promise.isNull(), "tat_not_assigned"),
            ((F.to_date(attempted) <= promise) & (day > promise), "after_tat_but_attempt"),
            (day == promise, "on_tat"),
            (day < promise, "before_tat"),
            (day > promise, "after_tat"),
        ]
    )


def delay_class(
    attempted: str = ATTEMPTS[0], promised: str = "expected_date_of_delivery_max"
) -> Column:
    """First attempt against the latest promise."""
    late = days_between(attempted, promised)
    return first_match(
        [
            (F.col(attempted).isNull(), "not_attempted"),
            (F.col(promised).isNull(), "no_expected_date"),
            (late <= 0, "on_time_or_early"),
            *[(late == n, label) for n, label in LATE_LABELS.items()],
        ],
        "4plus_days_late",
    )


def shipped_rules(
    picked: str = "pickup_date", erp: str = "order_status", courier: str = "clickpost_unified_status"
) -> list[tuple[Column, object]]:
    """Final state of a tracked order; everything else keeps the courier's status."""
    c = F.col(courier)
    return [
        (F.col(picked).isNull() & F.col(erp).isin(*NEVER_SENT), "Cancelled"),
        (F.col(picked).isNull(), "Not Picked"),
        *[(c.isin(*raw), label) for label, raw in COURIER_STATES.items()],
        (c.like("RTO%"), "RTO"),
    ]


def warehouse_rules(
    erp: str = "order_status", shipping: str = "shipping_status", courier: str = "clickpost_unified_status"
) -> tuple[list[tuple[Column, object]], Column]:
    """Final state from three status columns, and the text for an unforeseen mix."""
    e, s, c = F.col(erp), F.col(shipping), F.col(courier)
    le, ls, lc = F.lower(erp), F.lower(shipping), F.lower(courier)
    rules = [
        ((c == "Delivered") | (s == "Delivered"), "Delivered"),
        (lc.like("rto%") | (le == "returned"), "RTO"),
        (le == "cancelled", "Cancelled"),
        (le.like("%lost%") | lc.like("damaged%") | lc.like("%lost%") | ls.like("%lost%"), "Lost"),
        (lc.isin(*ON_THE_WAY), "Pending"),
        (le.isin(*IN_PACKING), "Pending for Packing"),
        ((e == "Shipped") & (s == "Shipment Created") & c.isin(*NOT_YET_PICKED), "Questionable"),
        ((e == "Shipped") & (s == "Picked Up"), "Pending"),
    ]
    return rules, F.concat(e, F.lit("-"), s, F.lit("-"), F.coalesce(c, F.lit("NULL")))


def final_status(rules: Sequence[tuple[Column, object]], otherwise: Column) -> Column:
    """First state whose rule holds."""
    return first_match(rules, otherwise)


def pickup_alert(created: str, picked: str, cutoff: int = 14) -> Column:
    """1 if an order placed before the cutoff hour was not picked up the same day, or a later
    one not by the next day."""
    gap = days_between(picked, created)
    early = F.hour(created) < cutoff
    return F.when(early & (gap != 0), 1).when(~early & (gap > 1), 1).otherwise(0)


def reattempt_alert(
    first: str = ATTEMPTS[0], second: str = ATTEMPTS[1], hours: int = 48, mode: str = "elapsed"
) -> Column:
    """1 if the second attempt came ``hours`` or more after the first."""
    return F.when(hours_between(second, first, mode) >= hours, 1).otherwise(0)


def ship_bucket(days: Column | str, status: Column | str) -> tuple[Column, Column]:
    """Label and sort key of the days from order to pickup."""
    days, status = (F.col(c) if isinstance(c, str) else c for c in (days, status))
    label = first_match(
        [
            (status.isin("Not Picked", "Cancelled"), status),
            (days.isin(0, 1), "DAY 1"),
            (days.between(2, 9), F.concat(F.lit("DAY "), days.cast("string"))),
            (days >= 10, "DAY 10+"),
        ],
        "Cancelled",
    )
    order = first_match(
        [
            (status == "Not Picked", 98),
            (status == "Cancelled", 99),
            (days.isin(0, 1), 1),
            (days.between(2, 9), days.cast("int")),
            (days >= 10, 10),
        ],
        99,
    )
    return label, order


def sla_breach(
    latest: str, status: str, as_of: datetime, hours: int = 48, mode: str = "boundary"
) -> Column:
    """1 if a moving parcel has been silent for more than ``hours``."""
    silent = hours_between(moment(as_of), latest, mode) > hours
    return F.when(silent & F.col(status).isin(*MOVING_STATES), 1).otherwise(0)


def mismatch_rto(
    picked: str = "pickup_date", erp: str = "order_status", courier: str = "clickpost_unified_status"
) -> Column:
    """1 if the ERP gave the order up while the courier says otherwise, or never saw it."""
    e, c = F.lower(erp), F.lower(courier)
    unseen = F.col(picked).isNull() & e.isin(*STUCK_ERP_STATES) & F.col(courier).isNull()
    contradicts = e.isin("returned", "cancelled") & ~c.like("rto%") & (c != "cancelled")
    return F.when(unseen, 1).when(contradicts, 1).otherwise(0)
