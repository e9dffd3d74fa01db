"""Result tables and campaign files.

Queries that write use a fresh path in the cluster's shared folder.
"""

import uuid
from datetime import date, datetime

from pyspark.sql import functions as F

from ..plans.campaigns import campaign_ingest as ingest
from ..session import shared_folder
from ..sources import catalog as k
from ..sources import csv_folder as c
from ..sources import tables as w
from .standins import oracle, register, table

MARK = date(2000, 1, 1)
SPLIT = date(1995, 6, 30)
NOW = datetime(2024, 2, 1, 8, 0)

register(
    {
        "in_runs": """
            SELECT l_partkey AS product_id, l_suppkey AS sku_id, CAST(l_shipdate AS DATE) AS order_date, l_returnflag AS category,
              l_linenumber AS runid, l_quantity AS gross_units, l_extendedprice AS gmv FROM {lineitem}""",
        "in_cells": """
            SELECT event_id, user_id, event_type, CASE user_id % 6 WHEN 0 THEN 'Excluded' WHEN 1 THEN 'excluded now' WHEN 2 THEN '  '
                WHEN 3 THEN NULL WHEN 4 THEN 'exl' || props ELSE 'say "hi", all' END AS note,
              CASE WHEN value < 5 THEN 'N/A' ELSE CAST(value AS STRING) END AS amount,
              CASE WHEN value > 200 THEN NULL ELSE value END AS value FROM {events}""",
    }
)
RUN_KEYS = ["product_id", "sku_id", "order_date", "category"]
RUN_TIES = ["gross_units", "gmv"]


RUN_COLUMNS = ["product_id", "sku_id", "order_date", "category", "gross_units", "gmv"]


def named(prefix: str) -> str:
    """A table name of its own for each call."""
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


def table_replace(spark, sf):
    """A named table written twice; the second content replaces the first."""
    name = named("replaced")
    k.write_table(table(spark, sf, "customer"), name)
    k.write_table(table(spark, sf, "supplier"), name)
    return spark.table(name)


def first_build(spark, sf):
    name = named("runs")
    k.first_build(table(spark, sf, "in_runs"), name, RUN_KEYS, "order_date", "runid", RUN_TIES)
    return spark.table(name).select(*RUN_COLUMNS)


def _append_runs(spark, sf, split):
    """A first build up to ``split``; a run of the whole feed that breaks off after staging and is run
    again; the same run once more; a second run with nothing new."""
    name, runs = named("runs"), table(spark, sf, "in_runs")
    k.first_build(runs.where(F.col("order_date") <= F.lit(split)), name, RUN_KEYS, "order_date", "runid", RUN_TIES)
    states = [
        k.staged_append(runs, name, run, RUN_KEYS, "order_date", "runid", RUN_TIES, floor=MARK, commit=commit)
        for run, commit in (("run-1", False), ("run-1", True), ("run-1", True), ("run-2", True))
    ]
    assert states == ["staged", "committed", "unchanged", "committed"], states
    return spark.table(name).select(*RUN_COLUMNS)


def incremental_append(spark, sf):
    return _append_runs(spark, sf, MARK)


def staged_append(spark, sf):
    return _append_runs(spark, sf, SPLIT)


def append_evolve(spark, sf):
    path, events = shared_folder(spark), table(spark, sf, "events")
    w.append_evolve(events.where("event_type = 'click'").select("event_id", "value"), path)
    rest = events.where("event_type <> 'click'").select("event_id", "value", "event_type")
    w.append_evolve(rest.withColumn("loaded_at", F.lit(NOW.isoformat()).cast("timestamp_ntz")), path)
    return w.read_table(spark, path)


def concat_by_name(spark, sf):
    customers = table(spark, sf, "customer").select(
        F.lit(0).alias("row"), F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = table(spark, sf, "supplier").select(
        F.lit(1).alias("row"), F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name")
    )
    return c.concat_by_name([customers, suppliers])


def align_schema(spark, sf):
    target = spark.createDataFrame([], "missing string, user_id string, value double, later timestamp_ntz").schema
    return w.align_schema(table(spark, sf, "events"), target)


def scrub_cells(spark, sf):
    return c.scrub_cells(table(spark, sf, "in_cells"))


def campaign_ingest(spark, sf):
    """Events written as campaign files of four channels, ingested into text tables."""
    folder, target = shared_folder(spark), shared_folder(spark)
    cells = table(spark, sf, "in_cells")
    files = {
        "Jan_Email.csv": ("click", {"#": "event_id", "Campaign Name": "note", "Open-Rate (%)": "amount"}),
        "feb email_sms.csv": ("view", {"#": "event_id", "Campaign Name": "note", "Sent/Total": "user_id"}),
        "SMS_all.csv": ("purchase", {"#": "event_id", "Amount,INR": "amount"}),
        "push1.csv": ("signup", {"#": "event_id", "  User  Id ": "user_id"}),
        "WhatsApp.csv": ("error", {"#": "event_id", "Note": "note", "A--B": "value"}),
        "readme.csv": ("click", {"#": "event_id"}),
    }
    for name, (kind, columns) in files.items():
        frame = cells.where(F.col("event_type") == kind).select(*[F.col(v).alias(k) for k, v in columns.items()])
        frame.write.option("header", "true").option("escape", '"').option(
            "ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(f"{folder}/{name}")
    ingest(spark, folder, target, NOW)
    parts = [
        w.read_table(spark, f"{target}/{channel}").withColumn("channel", F.lit(channel)) for channel in c.ROUTES
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


QUERIES = {
    "table_replace": table_replace,
    "first_build": first_build,
    "incremental_append": incremental_append,
    "staged_append": staged_append,
    "append_evolve": append_evolve,
    "concat_by_name": concat_by_name,
    "align_schema": align_schema,
    "scrub_cells": scrub_cells,
    "campaign_ingest": campaign_ingest,
}


def _runs(order: str, where: str) -> str:
    return f"""SELECT product_id, sku_id, order_date, category, gross_units, gmv FROM (SELECT *, row_number() OVER (
        PARTITION BY product_id, sku_id, order_date, category ORDER BY runid {order}, gross_units, gmv) AS rn
      FROM in_runs WHERE {where}) WHERE rn = 1"""


_SCRUB = "CASE WHEN {0} IS NULL OR regexp_matches({0}, 'excl|exl') OR trim({0}) = '' OR {0} IN ('N/A', 'NA') THEN '0' ELSE {0} END"
_NOTE, _AMOUNT = _SCRUB.format("note"), _SCRUB.format("amount")
_VALUE = "coalesce(CAST(value AS STRING), '0')"
_T = "'2024-02-01 08:00:00' AS pg_extracted_at"

ORACLE = {
    "table_replace": "SELECT * FROM supplier",
    "first_build": oracle(_runs("ASC", "TRUE")),
    "incremental_append": oracle(f"""
        WITH old AS ({_runs('ASC', "order_date <= DATE '2000-01-01'")})
        SELECT * FROM old UNION ALL
        SELECT DISTINCT * FROM ({_runs('DESC', "order_date > (SELECT max(order_date) FROM old)")})"""),
    "staged_append": oracle(f"""
        WITH old AS ({_runs('ASC', "order_date <= DATE '1995-06-30'")})
        SELECT * FROM old UNION ALL
        SELECT DISTINCT * FROM ({_runs('DESC', "order_date > (SELECT max(order_date) FROM old)")})"""),
    "append_evolve": """
        SELECT event_id, value, NULL AS event_type, NULL AS loaded_at FROM events WHERE event_type = 'click'
        UNION ALL SELECT event_id, value, event_type, TIMESTAMP '2024-02-01 08:00:00' FROM events WHERE event_type <> 'click'""",
    "concat_by_name": """
        SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS balance FROM customer
        UNION ALL SELECT NULL, s_name, NULL, s_acctbal FROM supplier""",
    "align_schema": """
        SELECT CAST(NULL AS STRING) AS missing, CAST(user_id AS STRING) AS user_id, value, CAST(NULL AS TIMESTAMP) AS later FROM events""",
    "scrub_cells": oracle(f"""
        SELECT event_id, user_id, event_type, {_NOTE} AS note, {_AMOUNT} AS amount, coalesce(value, 0) AS value FROM in_cells"""),
    "campaign_ingest": oracle(f"""
        SELECT 'email' AS channel, {_NOTE} AS campaign_name, {_AMOUNT} AS "open_rate__%_", NULL AS sent_total, {_T}, NULL AS amount_inr,
          NULL AS user_id, NULL AS note, NULL AS a_b FROM in_cells WHERE event_type = 'click'
        UNION ALL SELECT 'email', {_NOTE}, NULL, CAST(user_id AS STRING), {_T}, NULL, NULL, NULL, NULL FROM in_cells
          WHERE event_type = 'view'
        UNION ALL SELECT 'sms', NULL, NULL, NULL, {_T}, {_AMOUNT}, NULL, NULL, NULL FROM in_cells WHERE event_type = 'purchase'
        UNION ALL SELECT 'push', NULL, NULL, NULL, {_T}, NULL, CAST(user_id AS STRING), NULL, NULL FROM in_cells
          WHERE event_type = 'signup'
        UNION ALL SELECT 'whatsapp', NULL, NULL, NULL, {_T}, NULL, NULL, {_NOTE}, {_VALUE} FROM in_cells WHERE event_type = 'error'"""),
}
