from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import forecast, listing
from ledgerloom.plans.campaigns import campaign_ingest
from ledgerloom.session import shared_folder
from ledgerloom.sources import csv_folder as c
from ledgerloom.sources import tables as w

KEYS, SCHEMA = ["k"], "k string, day date, run int, v int"
D = lambda d: date(2024, 1, d)


def state(spark, path):
    return sorted(tuple(r) for r in w.read_table(spark, path).collect())


def test_incremental_append_high_water_mark(spark, tmp_path):
    path = str(tmp_path / "t")
    feed = lambda *rows: spark.createDataFrame(rows, SCHEMA)
    first = feed(("a", D(1), 1, 10), ("a", D(1), 2, 11), ("b", D(2), 1, 20))
    w.incremental_append(first, path, KEYS, "day", "run")  # empty target: everything after the epoch
    assert state(spark, path) == [("a", D(1), 11), ("b", D(2), 20)]
    more = feed(("c", D(1), 1, 1), ("d", D(2), 1, 2), ("e", D(3), 1, 3), ("e", D(3), 5, 4))
    for _ in range(2):  # repeating the load changes nothing
        w.incremental_append(more, path, KEYS, "day", "run")
        assert state(spark, path) == [("a", D(1), 11), ("b", D(2), 20), ("e", D(3), 4)]


def test_first_build_keeps_the_lowest_run(spark, tmp_path):
    path = str(tmp_path / "t")
    w.first_build(spark.createDataFrame([("a", D(1), 2, 11), ("a", D(1), 1, 10)], SCHEMA), path, KEYS, "run")
    assert state(spark, path) == [("a", D(1), 10)]


def test_shared_folder_is_the_one_the_cluster_names(spark, tmp_path):
    class Session:
        conf = {"spark.checkpoint.dir": str(tmp_path)}

    a, b = shared_folder(Session()), shared_folder(Session())
    assert a != b and a.startswith(str(tmp_path)) and b.startswith(str(tmp_path))


def test_a_cluster_must_name_the_shared_folder():
    class Session:
        conf = {}

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(RuntimeError):
        shared_folder(Session())


def test_headers():
    assert c.normalise_headers([" Open  Rate ", "a-b/c,d(e)", "x__y", "x___y"]) == ["open_rate", "a_b_c_d_e_", "x_y", "x__y"]
    with pytest.raises(ValueError):
        c.normalise_headers(["a b", "A-B"])


def test_campaign_folder(spark, tmp_path):
    files = {
        "1_Email.csv": 'id,Name,Open-Rate\n1,"two\nlines ""q""",5\n2,Excluded,\n3,NA,x excl y\n',
        "2_email_sms.csv": "id,Name,Clicks\n4,EXCLUDED,7\n",
        "3_push.csv": "id\n9\n",
        "4_whatsapp.csv": "",
        "5_sms.csv": "id,Text\n",
        "notes.csv": "id,a\n1,2\n",
    }
    (tmp_path / "in").mkdir()
    for name, text in files.items():
        (tmp_path / "in" / name).write_text(text)
    target = str(tmp_path / "out")
    done = campaign_ingest(spark, str(tmp_path / "in"), target, datetime(2024, 2, 1, 8))
    assert done == {"email": True, "push": True, "sms": False}
    stamp = "2024-02-01 08:00:00"
    rows = {tuple(r) for r in w.read_table(spark, f"{target}/email").select("name", "open_rate", "pg_extracted_at", "clicks").collect()}
    assert rows == {('two\nlines "q"', "5", stamp, None), ("Excluded", "0", stamp, None), ("0", "0", stamp, None), ("EXCLUDED", None, stamp, "7")}
    push = w.read_table(spark, f"{target}/push")
    assert push.columns == ["pg_extracted_at"] and push.count() == 1


def test_append_text_follows_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    assert w.append_text(spark.createDataFrame([(1, 2.5)], "a int, b double"), path)
    assert w.append_text(spark.createDataFrame([("x", 7)], "c string, b int"), path)
    assert not w.append_text(spark.createDataFrame([], "a int"), path)
    rows = w.read_table(spark, path).select("a", "b").collect()
    assert {tuple(r) for r in rows} == {("1", "2.5"), (None, "7")}


def test_append_evolve_reads_old_rows_with_null(spark, tmp_path):
    path = str(tmp_path / "t")
    w.append_evolve(spark.createDataFrame([(1,)], "a int"), path)
    w.append_evolve(spark.createDataFrame([(2, "x")], "a int, b string"), path)
    assert {tuple(r) for r in w.read_table(spark, path).collect()} == {(1, None), (2, "x")}


def test_concat_by_name_drops_one_column_only_if_there_are_more(spark):
    a, b = spark.createDataFrame([(0, 1)], "i int, x int"), spark.createDataFrame([(0, 2)], "i int, y int")
    out = c.concat_by_name([a, b])
    assert out.columns == ["x", "y"] and {tuple(r) for r in out.collect()} == {(1, None), (None, 2)}
    assert c.concat_by_name([a.select("i")]).columns == ["i"]


PAGES = [
    ("seller", "<a id=s> Shop </a>", None), ("price", "<i id=p>9.50</i>", None), ("both", "<i id=p>1</i><a id=s>Me</a>", None),
    ("none", "<p>", None), ("error", "<a id=s>x</a>", "timeout"), ("unseen", None, None),
]


def test_listing_status_and_retry(spark):
    pages = spark.createDataFrame(PAGES, "k string, html string, error string")
    first = listing.listing_status(pages, "<a id=s>([^<]*)</a>", "<i id=p>([^<]*)</i>", error="error").drop("html", "error")
    assert {r.k: r.seller_name for r in first.collect()} == {
        "seller": "Shop", "price": "OUT_OF_STOCK_PRICE: 9.50", "both": "Me", "none": "N/A - Data Not Found",
        "error": "N/A - Error Occurred", "unseen": "N/A - Failed to Scrape",
    }
    retry = spark.createDataFrame(
        [("none", "Found"), ("error", "N/A - Data Not Found"), ("seller", "must not win")], "k string, seller_name string"
    )
    got = {r.k: r.seller_name for r in listing.retry_merge(first, retry, "k").collect()}
    assert (got["none"], got["error"], got["unseen"], got["seller"]) == (
        "Found", "N/A - Data Not Found", "N/A - Failed to Scrape", "Shop"
    )


def test_unknown_seller_counts_as_success_and_as_not_ours(spark):
    df = spark.createDataFrame([(None,), ("OURS ltd.",), ("N/A - x",), ("Other",)], "seller_name string")
    assert tuple(listing.seller_exclusion(df, "Ours Ltd.").first()) == (4, 3)
    assert tuple(listing.outcome_counts(df).first()) == (3, 1)


def test_report_date(spark):
    df = spark.createDataFrame([("2024-01-05", datetime(2024, 2, 1))], "created_date string, at timestamp_ntz")
    assert listing.report_date(df).first()[0] == "2024-01-05"
    assert listing.report_date(df.drop("created_date")).first()[0] == "2024-02-01"
    assert listing.report_date(df.limit(0), default=D(3)).first()[0] == "2024-01-03"
    assert listing.report_date(spark.range(1)).first()[0] is None


def test_variance_text_and_bands(spark):
    rows = [(D(1), 1234.0, 1000.0), (D(2), None, 5.0), (D(3), 3.0, 0.0), (D(4), 9.0, 10.0), (D(5), 9999.9, 10000.0)]
    df = spark.createDataFrame(rows, "order_date date, x_actual double, x_projected double")
    got = {r.order_date.day: (r.actual_text, r.a_p_text, r.a_p_pct_text, r.band) for r in forecast.variance(df, ["x"]).collect()}
    assert got == {
        1: ("1,234", "234", "23.4%", "high"), 2: ("", "", "", None), 3: ("3", "3", "", None), 4: ("9", "-1", "-10.0%", "low"),
        5: ("10,000", "-0", "-0.0%", None),
    }


def test_accuracy_is_zero_without_a_forecast(spark):
    rows = [(D(d), float(d), 0.0, 8.0, 10.0) for d in range(1, 11)]
    df = spark.createDataFrame(rows, "order_date date, x_actual double, x_projected double, y_actual double, y_projected double")
    got = {r.place: (r.actual_mean, r.accuracy) for r in forecast.forecast_accuracy(df, 7, ["x", "y"]).collect()}
    assert got["x"] == (7.0, 0.0)
    assert got["y"][1] == pytest.approx(80.0)


def test_month_bounds_of_the_forecast_query(spark):
    rows = [("Shopify", date(2024, 1, 31)), ("Shopify", date(2024, 2, 1)), ("Shopify", date(2024, 2, 29)), ("Shopify", date(2024, 3, 1)), ("X", date(2024, 2, 2))]
    df = spark.createDataFrame(rows, "channel_name string, order_date date").withColumns({"x_actual": F.lit(1.0), "x_projected": F.lit(1.0)})
    got = forecast.daily_wide_sum(df, "Shopify", date(2024, 2, 10), ["x"]).collect()
    assert [r.order_date.day for r in got] == [29, 1]
