"""Profit and loss: rewrites against the literal forms, and invariants."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import pnl, pricing
from ledgerloom.plans.daily_pnl import BRAND_SPENDS

LINES = "order_date date, order_name string, parent_sku string, master_title string, item_quantity double, item_mrp_price double"


def random_facts(spark, seed=7, hot=False):
    rnd = random.Random(seed)
    skus = ["A", "A", "A", "SAM1", "C-MINI", "D", None] if hot else ["A", "B", "SAM1", "C-MINI", "D", None]
    day = lambda: date(2024, 1, 1) + timedelta(days=rnd.randrange(40))
    lines = [
        (day(), f"o{rnd.randrange(60)}", rnd.choice(skus), rnd.choice(["bag", "soap", None]),
         float(rnd.randrange(1, 5)), rnd.choice([10.0, 20.5, None]))
        for _ in range(300)
    ]
    costs = [(rnd.choice(skus), day(), rnd.choice([1.25, 2.5, 3.75, None])) for _ in range(60)]
    catalogue = [("A", 100.0), ("SAM1", 80.0), ("SAM1", 90.0), ("C-MINI", None)]
    return (
        lines, costs, catalogue,
        spark.createDataFrame(lines, LINES),
        spark.createDataFrame(costs, "sku_name string, date date, cogs_ double"),
        spark.createDataFrame(catalogue, "parent_sku string, mrp double"),
    )


def literal_rates(costs, sku, day):
    """All costs of the latest day on or before ``day``."""
    days = [d for s, d, _ in costs if s is not None and s == sku and d <= day]
    return [c for s, d, c in costs if s == sku and d == max(days)] if days else []


def test_asof_rate_is_the_correlated_form(spark):
    lines, costs, _, facts, history, _ = random_facts(spark)
    rates = history.select(F.col("sku_name").alias("parent_sku"), F.col("date").alias("d"), "cogs_")
    got = pnl.asof_rate(facts, rates, "parent_sku", "order_date", "d", "cogs_").collect()
    want = [
        (s, d, c) for s, d in {(x[2], x[0]) for x in lines if x[2]} for c in literal_rates(costs, s, d)
    ]
    order = lambda r: (r[0], r[1], r[2] is None, r[2] or 0)
    assert sorted([(r.parent_sku, r.order_date, r.cogs_) for r in got], key=order) == sorted(want, key=order)
    one = pnl.asof_rate(facts, rates, "parent_sku", "order_date", "d", "cogs_", ties="one")
    assert one.groupBy("parent_sku", "order_date").count().where("count > 1").count() == 0


@pytest.mark.parametrize("hot", [False, True])
def test_cogs_split_is_the_fan_out_form(spark, hot):
    lines, costs, catalogue, facts, history, cat = random_facts(spark, 11, hot)
    want = {}
    for day, _, sku, title, qty, mrp in lines:
        by_sku = None if sku is None else sku.startswith("SAM") or "MINI" in sku
        by_title = None if title is None else "bag" in title
        free = True if by_sku or by_title else (None if by_sku is None or by_title is None else False)
        best = max([m for s, m in catalogue if s == sku and m is not None], default=0)
        for cost in literal_rates(costs, sku, day) or [None]:
            row = want.setdefault(day, [0.0, 0.0, 0.0, 0])
            guess = None if mrp is None else mrp * 0.15 * qty
            if free is False:
                row[0] += cost * qty if cost is not None else guess or 0
                row[2] += (guess or 0) if cost is None else 0
                row[3] += cost is None
            elif free:
                row[1] += cost * qty if cost is not None else best * 0.15 * qty
    got = {r.order_date: r for r in pnl.cogs_split(facts, history, cat).collect()}
    assert set(got) == set(want)
    for day, row in want.items():
        r = got[day]
        assert [r.less_cogs, r.freebie_cogs, r.cogs_from_fallback] == pytest.approx(row[:3])
        assert r.fallback_lines == row[3]


def test_line_cogs_keeps_the_rows(spark):
    *_, facts, history, cat = random_facts(spark, 3)
    assert pnl.line_cogs(facts, history, cat).count() == facts.count()


def test_kit_with_both_rates_takes_the_higher_and_does_not_double(spark):
    cat = spark.createDataFrame(
        [("K", "Hair Oil kit", "x", "Combo"), ("K", "Soap kit", "x", "combo"), ("S", "Soap", "x", "Single")],
        "parent_sku string, master_title string, sub_category string, type_of_product string",
    )
    lines = spark.createDataFrame(
        [("K", "Hair Oil kit", None, 118.0), ("S", "HAIR OIL", None, 105.0), (None, None, None, 118.0)],
        "parent_sku string, master_title string, sub_category string, item_selling_rev double",
    )
    got = pnl.embedded_tax(lines, pnl.kit_rates(cat)).collect()
    assert sorted(round(r.item_gst, 6) for r in got) == [5.0, 18.0, 18.0]


def test_shipping_ignores_repeated_charges_and_falls_back(spark):
    lines = spark.createDataFrame(
        [(date(2024, 1, 1), "o1"), (date(2024, 1, 1), "o1"), (date(2024, 1, 1), "o2"), (date(2024, 1, 2), None)],
        "order_date date, order_name string",
    )
    charges = [("o1", "a", "Forward", 30.0), ("o1", "a", "Forward", 30.0), ("o1", "a", "RTO", 12.5), ("o2", "b", None, None)]
    df = spark.createDataFrame(charges * 3, "order_number string, awb_no string, charge_type string, final_charge double")
    got = {r.order_date.day: (r.actual_shipping, r.fallback_orders) for r in pnl.shipping_rollup(lines, df).collect()}
    assert got == {1: (82.5, 1), 2: (40.0, 1)}


def test_waterfall_adds_up(spark):
    row = dict(
        order_date=date(2024, 1, 1), gross_orders=2, gmv=200.0, total_selling_rev=150.0, returns_mrp=None, gross_sales=118.0,
        gst=18.0, less_cogs=20.0, freebie_cogs=1.0, cogs_from_fallback=0.0, fallback_lines=None, actual_shipping=None,
        fallback_orders=None, g=7.0, m=3.0, **{b: 1.0 for b in BRAND_SPENDS},
    )
    schema = ", ".join(
        f"{k} " + ("date" if k == "order_date" else "bigint" if k in ("gross_orders", "fallback_lines", "fallback_orders") else "double")
        for k in row
    )
    r = pnl.pnl_waterfall(spark.createDataFrame([tuple(row.values())], schema), "g", "m", BRAND_SPENDS).first()
    assert (r.mrp_value, r.net_sales, r.shipping) == (200.0, 100.0, 80.0)
    assert r.gross_profit == pytest.approx(100 - 21 - 1.4)
    assert r.cm1 == pytest.approx(r.gross_profit - 0.65 - 3.0 - 80)
    assert r.cm2 == pytest.approx(r.cm1 - r.search - r.social - r.brand_marketing)


def test_hot_and_cold_do_not_overlap(spark):
    days = [date(2024, 1, d) for d in (8, 9, 10)]
    hot = spark.createDataFrame([("a", d, v, "1.5") for d in days for v in (1, 2)], "ad string, date_start date, v int, spend string")
    cold = spark.createDataFrame([(d, 7.0) for d in days], "date_start date, spend double")
    got = pnl.hot_cold_union(hot, cold, date(2024, 1, 10), ["ad", "date_start"], "v").collect()
    assert {r.order_date.day: r.spend for r in got} == {8: 7.0, 9: 1.5, 10: 1.5}


def test_weight_slabs(spark):
    weights = [0.0, 250.0, 251.0, 500.0, 501.0, 1000.0, 1001.0]
    df = spark.createDataFrame([("X", w) for w in weights] + [("Shiprocket", 1001.0)], "rc_partner string, max_weight double")
    got = [(r.weight_ceiling_grams, r.first_weight_slab, r.extra_slabs) for r in pricing.weight_slabs(df).collect()]
    assert got == [(250, 250, 0), (250, 250, 0), (500, 500, 0), (500, 500, 0), (1000, 500, 1), (1000, 500, 1), (1500, 500, 2), (1500, 500, 0)]


def test_unknown_partner_costs_nothing(spark):
    df = spark.createDataFrame(
        [("Forward", "cod", 1000.0, None, None, None, None, 1, None, None), (None, "cod", 1000.0, 30.0, 10.0, 20.0, 5.0, 2, 25.0, 0.05),
         ("RTO", "COD", 1000.0, 30.0, 10.0, 20.0, 5.0, 2, 25.0, 0.05), ("Forward", "COD", 1000.0, 30.0, 10.0, 20.0, 5.0, 2, 25.0, 0.05)],
        "charge_type string, payment_mode string, order_invoice_value double, fwd_first_rate double, fwd_add_rate double, "
        "rto_first_rate double, rto_add_rate double, extra_slabs bigint, cod_flat double, cod_pct double",
    )
    got = [(r.cps, r.final_charge, r.rate_missing) for r in pricing.charge_legs(df).collect()]
    assert got == [(0.0, 0.0, 1), (None, None, 0), (80.0, 80.0, 0), (50.0, 100.0, 0)]
