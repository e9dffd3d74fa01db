"""Status vocabularies of three order systems and the mapping to a common one."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .ids import _col

# Unified status -> spellings after lower-casing and '-' -> ' '.
SHOP_STATUS = {
    "Shipped": ["fulfilled"],
    "Processing": ["partial"],
    "Order Created": ["unknown"],
}
ERP_STATUS = {
    "Processing": [
        "assign pending", "approve pending", "pending", "confirmed", "assigned", "printed",
        "manifest scanned", "upcoming", "on hold",
    ],
    "Ready to Dispatch": ["ready to dispatch"],
    "Shipped": ["shipped"],
    "Returned (RTO)": ["returned"],
    "Cancelled": ["cancelled"],
}
RTO_DELIVERED = ["rto delivered", "rtodelivered"]
RTO_ANY = [
    "rto requested", "rtorequested", "rto intransit", "rtointransit", "rto outfordelivery",
    "rtooutfordelivery", *RTO_DELIVERED, "rto marked", "rtomarked", "rto failed", "rtofailed",
]
COURIER_STATUS = {
    "Processing": [
        "orderplaced", "awb registered", "awbregistered", "pickuppending", "pickup pending",
        "outforpickup", "out for pickup", "pickupfailed", "pickup failed", "nostatusexist",
        "no status exist",
    ],
    "Shipped": ["pickedup", "picked up", "origincityout", "origin city out"],
    "In Transit": [
        "origincityin", "origin city in", "intransit", "in transit", "destinationhubin",
        "destination hub in", "shipmentdelayed", "shipment delayed",
    ],
    "Out For Delivery": ["outfordelivery", "out for delivery"],
    "Delivered": ["delivered"],
    "Returned (RTO)": RTO_ANY,
    "Delivery Failed": ["faileddelivery", "failed delivery"],
    "Cancelled": ["cancelled"],
    "Exception": ["lost", "damaged", "contactcustomercare", "contact customer care"],
}


def plain_status(col: Column | str) -> Column:
    """Lower case, '-' read as a space."""
    return F.replace(F.lower(_col(col)), F.lit("-"), F.lit(" "))


def first_match(rules: Sequence[tuple[Column, object]], default=None) -> Column:
    """Value of the first rule whose condition is true (NULL counts as not true)."""
    out = None
    for condition, value in rules:
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(condition, value) if out is None else out.when(condition, value)
    if out is None:
        raise ValueError("no rules")
    return out.otherwise(default if isinstance(default, Column) else F.lit(default))


def unify_status(
    col: Column | str,
    vocabulary: Mapping[str, Sequence[str]],
    key: Column | None = None,
) -> Column:
    """Map a status to a small vocabulary; an unknown one passes through unchanged.

    ``key`` is the text that is looked up, by default :func:`plain_status` of ``col``.
    """
    key = plain_status(col) if key is None else key
    return first_match([(key.isin(*words), label) for label, words in vocabulary.items()], _col(col))


def blank(col: Column | str) -> Column:
    """NULL or only spaces."""
    return _col(col).isNull() | (F.trim(_col(col)) == "")
