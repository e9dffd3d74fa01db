from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.ids import pad_id
from ledgerloom.operators import tracking as t

AT = lambda d, h=0, m=0: datetime(2024, 1, d, h, m)


def values(spark, rows, schema, col):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(col).collect()]


def test_pickup_alert_cutoff(spark):
    rows = [
        (AT(1, 13, 59), AT(1, 23)), (AT(1, 13, 59), AT(2, 0)), (AT(1, 14), AT(2, 23)), (AT(1, 14), AT(3, 0)),
        (AT(1, 14), None), (None, AT(1)), (AT(2, 9), AT(1, 9)), (AT(2, 15), AT(1, 9)),
    ]
    got = values(spark, rows, "c timestamp_ntz, p timestamp_ntz", t.pickup_alert("c", "p"))
    assert got == [0, 1, 0, 1, 0, 0, 1, 0]


def test_reattempt_alert_needs_48_full_hours(spark):
    rows = [(AT(1, 10), AT(3, 9, 59)), (AT(1, 10), AT(3, 10)), (AT(1, 10), None)]
    schema = f"{t.ATTEMPTS[0]} timestamp_ntz, {t.ATTEMPTS[1]} timestamp_ntz"
    assert values(spark, rows, schema, t.reattempt_alert()) == [0, 1, 0]


def test_ship_bucket(spark):
    rows = [(0, "X"), (1, "X"), (2, "X"), (9, "X"), (10, "X"), (-1, "X"), (None, "X"), (3, "Not Picked"), (3, "Cancelled"), (4, None)]
    label, order = t.ship_bucket("d", "s")
    df = spark.createDataFrame(rows, "d bigint, s string").select(label, order)
    assert [tuple(r) for r in df.collect()] == [
        ("DAY 1", 1), ("DAY 1", 1), ("DAY 2", 2), ("DAY 9", 9), ("DAY 10+", 10), ("Cancelled", 99), ("Cancelled", 99),
        ("Not Picked", 98), ("Cancelled", 99), ("DAY 4", 4),
    ]


def test_tat_takes_the_first_promise(spark):
    # delivered, attempted, promised by courier, latest, earliest
    rows = [
        (None, None, AT(5), None, None), (AT(5, 9), None, AT(5, 1), AT(1), None), (AT(4), None, AT(5), AT(1), None),
        (AT(6), AT(5, 23), AT(5), None, None), (AT(6), AT(6), None, AT(5), AT(9)), (AT(6), None, None, None, AT(7)),
        (AT(6), None, None, None, None),
    ]
    schema = ", ".join(f"{c} timestamp_ntz" for c in ["delivery_date", t.ATTEMPTS[0], *t.PROMISES])
    assert values(spark, rows, schema, t.tat_class()) == [
        "others", "on_tat", "before_tat", "after_tat_but_attempt", "after_tat", "before_tat", "tat_not_assigned",
    ]


def test_unforeseen_status_mix(spark):
    rules, rest = t.warehouse_rules()
    rows = [("Weird", "Odd", None), ("Weird", None, "X"), ("Shipped", "Picked Up", "X"), ("returned", None, None)]
    got = values(spark, rows, "order_status string, shipping_status string, clickpost_unified_status string", t.final_status(rules, rest))
    assert got == ["Weird-Odd-NULL", None, "Pending", "RTO"]


def test_to_local_moves_only_the_named_columns(spark):
    df = spark.createDataFrame([(AT(1, 20), AT(1, 20))], "created_at timestamp_ntz, pickup_date timestamp_ntz")
    assert tuple(t.to_local(df, ["pickup_date", "absent"], "Asia/Kolkata").first()) == (AT(1, 20), AT(2, 1, 30))


def test_routed_join_keeps_stores_apart(spark):
    erp = spark.createDataFrame(
        [("Shop", "1", "a"), ("Shop1", "1", "a"), ("Shop", "1", None), ("Else", "1", "a")], "mp_name string, raw string, awb_no string"
    ).withColumn("padded", pad_id("raw"))
    right = spark.createDataFrame(
        [("Shop", "0000000000001", "a", "S"), ("Shop1", "1", "a", "S1"), ("Shop1", "0000000000001", "a", "wrong"), ("Shop", "1", "a", "wrong")],
        "store string, order_id string, awb string, hit string",
    )
    routes = {"Shop": (F.col("padded"), "Shop"), "Shop1": (F.col("raw"), "Shop1")}
    got = t.routed_join(erp, right, routes, "mp_name", "order_id", "awb_no", "awb").collect()
    assert sorted((r.mp_name, r.awb_no or "", r.hit or "") for r in got) == [
        ("Else", "a", ""), ("Shop", "", ""), ("Shop", "a", "S"), ("Shop1", "a", "S1")
    ]


def test_sla_breach(spark):
    rows = [(AT(1), "InTransit"), (AT(3, 1), "InTransit"), (AT(1), "Delivered"), (None, "InTransit")]
    got = values(spark, rows, "l timestamp_ntz, s string", t.sla_breach("l", "s", AT(3, 1)))
    assert got == [1, 0, 0, 0]


@pytest.mark.parametrize("late, label", [(0, "on_time_or_early"), (1, "1_day_late"), (4, "4_days_late"), (5, "4plus_days_late")])
def test_delay_class(spark, late, label):
    schema = f"{t.ATTEMPTS[0]} timestamp_ntz, expected_date_of_delivery_max timestamp_ntz"
    assert values(spark, [(AT(5 + late, 1), AT(5, 23))], schema, t.delay_class()) == [label]
