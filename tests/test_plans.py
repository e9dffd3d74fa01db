"""Shapes of physical plans that matter on large data."""

import re

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import dedupe, pnl, recon, reshape
from ledgerloom.queries import all_queries
from ledgerloom.queries.standins import table
from ledgerloom.session import tune
from ledgerloom.sources import catalog

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_dedupe_cuts_a_hot_key_before_the_shuffle(spark):
    text = plan(dedupe.dedupe_latest(table(spark, SF, "lineitem"), ["l_orderkey"], "l_shipdate", ["l_partkey"]))
    assert re.search(r"WindowGroupLimit.*Partial", text) and re.search(r"WindowGroupLimit.*Final", text)
    assert text.index("Exchange hashpartitioning") < text.index("Partial")


def test_filters_and_columns_reach_the_scan(spark):
    lines = table(spark, SF, "lineitem").where(F.col("l_shipdate") >= F.lit("2000-01-01").cast("timestamp_ntz"))
    text = plan(pnl.spend_daily(lines, "l_shipdate", "l_quantity"))
    assert "GreaterThanOrEqual(l_shipdate" in text
    assert re.search(r"ReadSchema: struct<l_quantity:double,l_shipdate:timestamp_ntz>", text)


WITH_RANGE_TABLES = {  # stand-ins that number all pairs of nations, or a channel list, by a cross join
    "assign_zone", "chargeable_weight", "weight_slabs", "rate_lookup", "shipment_charges", "shipping_rollup",
    "pnl_daily", "pnl_daily_by_parts", "sales_union",
}


@pytest.mark.parametrize("name", sorted(set(all_queries()) - WITH_RANGE_TABLES))
def test_no_nested_loop_or_whole_table_window(no_broadcast, name):
    text = plan(all_queries()[name](tune(no_broadcast), SF))
    assert "NestedLoop" not in text and "CartesianProduct" not in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text
    for window in re.findall(r"\n\W*Window \[.*", text):
        assert not re.search(r"\], \[\], \[", window)


def test_hot_key_join_is_split(no_broadcast):
    """A third of the rows share one order; the join back to the lines splits them."""
    spark = no_broadcast
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        hot = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))
        amount = (F.col("id") % 100).cast("double")
        df = spark.range(0, 60000, 1, 8).select(
            hot.alias("shop_order_name"), amount.alias("shop_value"), amount.alias("erp_value"), amount.alias("courier_value")
        )
        out = recon.order_sign_flags(df, recon.order_rollup(df))
        assert out.where("order_s_vs_e_mismatch = 0").count() == 60000
        out.collect()
        assert "skew=true" in plan(out)
        kept = reshape.exclude_groups(df, "shop_order_name", F.col("shop_value") > 50)
        want = {"hot"} | {str(i) for i in range(60000) if i % 3 and i % 100 > 50}
        kept.collect()
        assert "skew=true" in plan(kept)
        assert {r[0] for r in kept.select("shop_order_name").distinct().collect()} == want
        assert kept.where("shop_order_name = 'hot'").count() == 20000
    finally:
        for k in settings:
            spark.conf.unset(k)


def test_sales_union_reads_lines_and_products_once_per_source(no_broadcast):
    """The wide feed and the mappings are written once; branches read the copies, not the joins behind them."""
    text = plan(all_queries()["sales_union"](tune(no_broadcast), SF))
    assert len(re.findall(r"Scan parquet .*lineitem", text)) <= 6  # the wide feed's copy aside, five small stand-ins
    assert len(re.findall(r"Scan parquet .*part\b", text)) <= 1


def test_sales_union_writes_only_what_the_feeds_are_made_from(spark, monkeypatch):
    from ledgerloom.queries import sales

    widths, written = [], sales.written
    monkeypatch.setattr(sales, "written", lambda df, by=None: (widths.append(len(df.columns)), written(df, by))[1])
    all_queries()["sales_union"](tune(spark), SF)
    assert max(widths) <= 16


def exchanges(text, column):
    """Shuffles that deal out by ``column``, counting each once."""
    return set(re.findall(rf"Exchange hashpartitioning\([^\n]*\b{column}#[^\n]*plan_id=(\d+)", text))


def test_reconciliation_shuffles_lines_once_per_key(no_broadcast):
    """ERP suborders are dealt out by AWB once, for sums and courier; lines by line once and by order once, and read once."""
    queries, spark = all_queries(), tune(no_broadcast)
    for name, by_order in (("recon_lines", 0), ("recon_flags", 0), ("recon_severity", 0), ("recon_order_rollup", 1), ("reconciliation", 1)):
        text = plan(queries[name](spark, SF))
        assert len(exchanges(text, "_awb_key")) == 1
        by_line = len(exchanges(text, "shop_order_item_id"))
        assert by_line <= 3  # shop, ERP with courier, returns where they are asked for
        assert len(exchanges(text, "shop_order_name")) == by_line + by_order
        assert len(re.findall(r"Scan parquet .*\bl_orderkey#", text)) <= 5


def test_warehouse_report_shuffles_each_courier_feed_once_for_the_join(no_broadcast):
    text = plan(all_queries()["warehouse_report"](tune(no_broadcast), SF))
    assert "FullOuter" not in text and len(exchanges(text, "_extra")) == 1


@pytest.mark.parametrize("name", ["pnl_daily", "pnl_daily_by_parts", "tracking_report"])
def test_reports_read_lines_with_orders_from_one_copy(no_broadcast, name):
    text = plan(all_queries()[name](tune(no_broadcast), SF))
    assert "Scan parquet" in text and "orders.parquet" not in text


def test_new_rows_of_an_append_are_not_grouped_again(spark):
    """One row per key is distinct: a grouping by all columns only holds a task's rows once more."""
    rows = spark.createDataFrame([(1, 1, 5, "a"), (1, 1, 6, "b"), (None, 1, 1, "c")], "k int, d int, v int, x string")
    new = catalog.fresh_rows(rows, None, ["k"], "d", "v", ["x"])
    assert "Aggregate" not in plan(new)
    assert sorted(map(tuple, new.collect()), key=str) == [(1, 1, "b"), (None, 1, "c")]
    both = catalog.fresh_rows(rows.union(rows.withColumn("x", F.lit("b"))), None, ["k", "v"], "d", "v", ["x"])
    assert both.count() == both.distinct().count()


def test_writes_put_settings_back(spark, monkeypatch):
    keys, seen = ["spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.coalescePartitions.initialPartitionNum"], []
    before = [spark.conf.get(k, None) for k in keys]
    by_day = catalog._by_day
    monkeypatch.setattr(catalog, "_by_day", lambda *a: seen.append([spark.conf.get(k, None) for k in keys]) or by_day(*a))
    catalog.write_table(spark.range(5), "settings_put_back")
    assert seen == [[f"{32 << 20}b", "200"]] and [spark.conf.get(k, None) for k in keys] == before


def test_warehouse_report_deals_each_feed_out_once_before_its_join(no_broadcast):
    text = plan(all_queries()["warehouse_report"](tune(no_broadcast), SF))
    assert "orders.parquet" not in text
    assert len(exchanges(text, "_padded")) == 2 and not exchanges(text, "order_id")
    assert len(exchanges(text, "order_number_raw")) == 0


@pytest.mark.parametrize("name", ["recon_lines", "reconciliation"])
def test_reconciliation_reads_lines_with_orders_from_one_copy(no_broadcast, name):
    text = plan(all_queries()[name](tune(no_broadcast), SF))
    assert "Scan parquet" in text and "orders.parquet" not in text and "lineitem.parquet" not in text
