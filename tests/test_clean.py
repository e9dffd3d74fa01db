from datetime import datetime

from pyspark.sql import functions as F

from ledgerloom.functions.ids import clean_id, null_marker, pad_id, spread_nulls
from ledgerloom.functions.numbers import round_money, safe_number, to_int64
from ledgerloom.functions.status import COURIER_STATUS, unify_status
from ledgerloom.functions.timing import days_in_month, hours_between
from ledgerloom.operators.dedupe import dedupe_any, dedupe_first, dedupe_latest, pick_preferred


def one(spark, rows, schema, col):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(col).collect()]


def test_clean_id(spark):
    raw = ["`12", '"12"', "12.0", "nan", " ", None, "1`2", "12.05", "abc"]
    got = one(spark, [(x,) for x in raw], "x string", clean_id("x"))
    assert got == ["12", "12", "12", None, None, None, "12", "12.05", "abc"]
    got = one(spark, [("`1`2",)], "x string", clean_id("x", strip=("leading_backtick",)))
    assert got == ["1`2"]


def test_pad_id_lengths(spark):
    raw = ["123456789012", "1234567890123", "12345678901234", None, ""]
    got = one(spark, [(x,) for x in raw], "x string", pad_id("x"))
    assert got == ["0123456789012", "1234567890123", "1234567890123", None, "0" * 13]


def test_safe_number(spark):
    raw = [("12",), ("12.0",), ("nan",), ("x",), (None,)]
    assert one(spark, raw, "x string", safe_number("x")) == [12.0, 12.0, None, None, None]
    assert one(spark, raw, "x string", safe_number("x", default=0)) == [12.0, 12.0, 0.0, 0.0, 0.0]
    assert one(spark, raw, "x string", safe_number("x", "bigint")) == [12, None, None, None, None]


def test_rounding(spark):
    assert one(spark, [(2.5,), (-2.5,), (2.4,)], "x double", to_int64("x")) == [3, -3, 2]
    assert one(spark, [(1.005,), (-1.005,)], "x double", round_money("x")) == [1.01, -1.01]


def test_null_marker_and_spread_nulls(spark):
    assert one(spark, [("#N/A",), ("a",)], "x string", null_marker("x")) == [None, "a"]
    keys = one(spark, [(None, i) for i in range(50)] + [("k", 1)], "x string, i int", spread_nulls("x", "i"))
    assert len(set(keys)) == 51 and "k" in keys and None not in keys


def test_unify_status_passes_unknown_through(spark):
    raw = [("RTO-Delivered",), ("in-transit",), ("Odd-One",), (None,)]
    got = one(spark, raw, "x string", unify_status("x", COURIER_STATUS))
    assert got == ["Returned (RTO)", "In Transit", "Odd-One", None]


def test_hours_between(spark):
    t = lambda h, m, d=1: datetime(2024, 1, d, h, m)
    rows = [(t(12, 1), t(10, 59)), (t(10, 59), t(12, 1)), (t(12, 0, 3), t(12, 1)), (None, t(1, 0))]
    schema = "a timestamp_ntz, b timestamp_ntz"
    assert one(spark, rows, schema, hours_between("a", "b")) == [1, -1, 47, None]
    assert one(spark, rows, schema, hours_between("a", "b", "boundary")) == [2, -2, 48, None]


def test_days_in_month(spark):
    rows = [("2024-02-01",), ("2023-02-28",), ("2000-02-29",), ("1900-02-01",), ("2024-12-31",)]
    assert one(spark, rows, "d string", days_in_month(F.to_date("d"))) == [29, 28, 29, 28, 31]


ROWS = [("a", 1, "x"), ("a", 3, "y"), ("a", 3, "z"), ("a", None, "n"), ("b", None, "p"), (None, 2, "q")]
SCHEMA = "k string, v int, t string"


def picked(df):
    return {(r.k, r.v, r.t) for r in df.collect()}


def test_dedupe(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert picked(dedupe_latest(df, ["k"], "v", ["t"])) == {("a", 3, "y"), ("b", None, "p"), (None, 2, "q")}
    assert picked(dedupe_first(df, ["k"], "v", ["t"])) == {("a", None, "n"), ("b", None, "p"), (None, 2, "q")}
    assert picked(dedupe_any(df, ["k"], ["t"])) == {("a", None, "n"), ("b", None, "p"), (None, 2, "q")}
    best = pick_preferred(df, ["k"], F.col("t") == "z", ["t"])
    assert picked(best) == {("a", 3, "z"), ("b", None, "p"), (None, 2, "q")}
    assert dedupe_latest(df.limit(0), ["k"], "v", ["t"]).count() == 0


def test_dedupe_by_expression(spark):
    df = spark.createDataFrame([("`1", 1), ("1", 2)], "k string, v int")
    got = dedupe_latest(df, [F.replace("k", F.lit("`"), F.lit(""))], "v").collect()
    assert [tuple(r) for r in got] == [("1", 2)]
