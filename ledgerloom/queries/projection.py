"""Projection of missing days and allocation of targets."""

from datetime import date

from pyspark.sql import functions as F

from ..functions.timing import month_start
from ..operators import projection as p
from ..operators.sales import FACT_DIMS, MEASURES
from ..plans import sales_projection as plan
from .standins import oracle, register, table

AS_OF = date(2024, 2, 10)
TARGETS = {"t_signup": "signup", "t_error": "error", "t_fair": "fair"}
MARKETPLACES = ["signup", "fair"]

register(
    {
        # each channel stops on a day of its own
        "in_fact": """
            SELECT CASE WHEN user_id < 100 THEN 'FIRST' ELSE 'SECOND' END AS brand,
              CASE WHEN event_type IN ('click', 'view') THEN 'Q-Com' ELSE 'E-Com' END AS com,
              CASE WHEN event_type = 'purchase' THEN 'Offline' ELSE 'Marketplace' END AS source_channel,
              event_type AS channel,
              CAST(ts AS DATE) - CASE event_type WHEN 'view' THEN 3 WHEN 'purchase' THEN 9 WHEN 'signup' THEN 1 ELSE 0 END AS order_date,
              'K' || user_id AS parent_sku,
              CASE WHEN user_id < 8 THEN NULL ELSE 'P' || (user_id % 12) END AS product_title,
              'M' || (user_id % 6) AS master_title,
              CASE WHEN user_id > 145 THEN NULL ELSE 'C' || (user_id % 3) END AS main_category,
              'S' || (user_id % 2) AS sub_category, CASE WHEN value > 150 THEN 'North' ELSE 'null' END AS region,
              value AS gmv, value - 0.25 AS gross_sales, floor(value / 10) + 1 AS units_sold
            FROM {events}""",
        "in_channel_targets": """
            SELECT * FROM (VALUES (DATE '2023-11-01', 3000.0, 1000.0, 900.0), (DATE '2024-01-01', 31000.0, NULL, 620.0),
              (DATE '2024-02-01', 43500.0, 29000.0, NULL), (DATE '2024-03-01', 100.0, 100.0, 100.0))
              AS t(month, t_signup, t_error, t_fair)""",
        # item targets above last month's sales; items without labels are marked as a sheet marks them
        "in_product_targets": """
            SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, channel,
              CASE WHEN main_category IS NULL THEN '#N/A' ELSE main_category END AS main_category,
              CASE WHEN product_title IS NULL THEN '#N/A' ELSE product_title END AS product_title,
              gmv * 2 AS final_product_target
            FROM {in_fact} WHERE region = 'North'""",
    }
)


def _daily(spark, sf):
    return p.daily_agg(table(spark, sf, "in_fact"))


def _targeted(spark, sf):
    return _daily(spark, sf).where(F.col("channel").isin(*TARGETS.values()))


def daily_agg(spark, sf):
    return _daily(spark, sf)


def trailing_mean(spark, sf):
    return p.trailing_mean(_daily(spark, sf))


def future_dates(spark, sf):
    return p.future_dates(p.last_dates(_daily(spark, sf)), 60, AS_OF)


def _flat(spark, sf):
    daily = _daily(spark, sf)
    return p.project_flat(p.trailing_mean(daily), p.last_dates(daily), daily, AS_OF)


def project_flat(spark, sf):
    return _flat(spark, sf).withColumn("is_projected", F.col("is_projected").cast("int"))


def rolling_projection(spark, sf):
    rolled = p.rolling_projection(_flat(spark, sf))
    return rolled.withColumn("is_projected", F.col("is_projected").cast("int"))


def unpivot_targets(spark, sf):
    """Targets next to what their channel sold in the month."""
    sold = _targeted(spark, sf).groupBy("channel", month_start("order_date").alias("month")).agg(
        F.sum(F.col("gmv").cast("decimal(28,6)")).cast("double").alias("sold")
    )
    targets = p.unpivot_targets(table(spark, sf, "in_channel_targets"), TARGETS)
    return targets.join(sold, ["channel", "month"], "left")


def _daily_targets(spark, sf):
    targets = p.unpivot_targets(table(spark, sf, "in_channel_targets"), TARGETS)
    first = _targeted(spark, sf).where("brand = 'FIRST'")
    return p.daily_target(targets, p.selling_price(first))


def contribution_share(spark, sf):
    return p.contribution(_targeted(spark, sf))


def allocate_target(spark, sf):
    first = _targeted(spark, sf).where("brand = 'FIRST'")
    with_data = first.select("channel", month_start("order_date").alias("month")).distinct()
    rows = p.allocate_target(
        _daily_targets(spark, sf), p.contribution(first), with_data, AS_OF, "FIRST", MARKETPLACES
    )
    return rows.withColumn("is_projected", F.col("is_projected").cast("int"))


def month_rollup(spark, sf):
    return p.month_rollup(_daily(spark, sf))


def last_month_to_date(spark, sf):
    return p.last_month_to_date(_daily(spark, sf), AS_OF, plan.LMTD_KEYS)


KEYS = ["month", "channel", "main_category", "product_title"]
TIES = ["parent_sku", "master_title", "sub_category", "brand", "com", "source_channel", "region"]


def target_allocation(spark, sf):
    return p.target_allocation(
        month_rollup(spark, sf), table(spark, sf, "in_product_targets"), KEYS, TIES,
        F.col("brand") == "FIRST",
    )


def sales_report(spark, sf):
    """Actuals, projections, targets and the previous month to date, per month and item."""
    return plan.sales_report(
        table(spark, sf, "in_fact"), table(spark, sf, "in_channel_targets"),
        table(spark, sf, "in_product_targets"), "FIRST", AS_OF, TARGETS, MARKETPLACES,
    )


QUERIES = {
    "daily_agg": daily_agg,
    "trailing_mean": trailing_mean,
    "future_dates": future_dates,
    "project_flat": project_flat,
    "rolling_projection": rolling_projection,
    "unpivot_targets": unpivot_targets,
    "daily_target": _daily_targets,
    "contribution_share": contribution_share,
    "allocate_target": allocate_target,
    "month_rollup": month_rollup,
    "last_month_to_date": last_month_to_date,
    "target_allocation": target_allocation,
    "sales_report": sales_report,
}

_ITEM = ", ".join(p.ITEM)
_DIMS = ", ".join(FACT_DIMS)


def total(x: str) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(28,6))) AS DOUBLE)"


def mean(x: str) -> str:
    return f"{total(x)} / CAST(nullif(count({x}), 0) AS DOUBLE)"


def each(f, prefix: str = "") -> str:
    return ", ".join(f"{f(prefix + m)} AS {m}" for m in MEASURES)


_TARGETED = "channel IN ('signup', 'error', 'fair')"


def chain(rolled: str, targeted: str) -> dict[str, str]:
    """The steps over the daily rows that are rolled and those that follow a channel target."""
    return {
        "daily": f"SELECT {_DIMS}, {each(total)} FROM in_fact GROUP BY ALL",
        "act": f"SELECT * FROM daily WHERE {rolled}",
        "tgt": f"SELECT * FROM daily WHERE {targeted}",
        "last": "SELECT brand, channel, max(order_date) AS max_date FROM act GROUP BY 1, 2",
        "means": f"""SELECT {_ITEM}, {each(mean)} FROM act JOIN last USING (brand, channel)
            WHERE order_date BETWEEN max_date - 6 AND max_date GROUP BY {_ITEM}""",
        "dates": """SELECT brand, channel, CAST(max_date + n AS DATE) AS order_date, CAST(n AS BIGINT) AS days_ahead
            FROM last CROSS JOIN (SELECT CAST(unnest(range(1, 61)) AS INTEGER) AS n) WHERE max_date + n <= DATE '2024-02-09'""",
        "flat": f"""SELECT {_DIMS}, gmv, gross_sales, units_sold, CAST(0 AS BIGINT) AS days_ahead, 0 AS is_projected FROM act
            UNION ALL SELECT {_DIMS}, gmv, gross_sales, units_sold, days_ahead, 1 FROM means JOIN dates USING (brand, channel)""",
        # the range self-join, only rows before the projected day
        "rolled": f"""SELECT {', '.join('a.' + d for d in FACT_DIMS)}, {each(mean, 'b.').replace('AS b.', 'AS ')}, 1 AS is_projected
            FROM (SELECT * FROM flat WHERE is_projected = 1) a LEFT JOIN flat b ON a.brand = b.brand AND a.channel = b.channel
              AND a.product_title = b.product_title AND a.master_title = b.master_title AND a.main_category = b.main_category
              AND a.sub_category = b.sub_category AND b.order_date BETWEEN a.order_date - 7 AND a.order_date - 1
              AND (b.days_ahead < a.days_ahead OR b.days_ahead = 0) GROUP BY ALL
            UNION ALL SELECT {_DIMS}, gmv, gross_sales, units_sold, 0 FROM flat WHERE is_projected = 0""",
        "targets": """SELECT * FROM (SELECT month, 'signup' AS channel, CAST(t_signup AS DOUBLE) AS monthly_target FROM in_channel_targets
            UNION ALL SELECT month, 'error', CAST(t_error AS DOUBLE) FROM in_channel_targets
            UNION ALL SELECT month, 'fair', CAST(t_fair AS DOUBLE) FROM in_channel_targets) WHERE monthly_target IS NOT NULL""",
        "latest": """SELECT t.*, m.month FROM tgt t JOIN (SELECT channel, max(date_trunc('month', order_date)) AS month FROM tgt GROUP BY 1) m
            ON t.channel = m.channel AND date_trunc('month', t.order_date) = m.month""",
        "asp": f"""SELECT channel, {total('gmv')} / nullif({total('units_sold')}, 0) AS price FROM latest GROUP BY ALL""",
        "day_targets": """SELECT t.channel, month, monthly_target, CAST(day(last_day(month)) AS BIGINT) AS days_in_month,
              monthly_target / day(last_day(month)) AS daily_target,
              monthly_target / day(last_day(month)) / nullif(price, 0) AS daily_units_target
            FROM targets t LEFT JOIN asp ON t.channel = asp.channel""",
        "shares": f"""SELECT i.*, g / nullif(tg, 0) AS sku_contribution_pct, u / nullif(tu, 0) AS sku_units_contribution_pct FROM (
              SELECT brand, com, channel, parent_sku, product_title, master_title, main_category, sub_category, region,
                {total('gmv')} AS g, {total('units_sold')} AS u FROM latest GROUP BY ALL) i
            JOIN (SELECT channel, {total('gmv')} AS tg, {total('units_sold')} AS tu FROM latest GROUP BY 1) USING (channel)""",
        "open_months": """SELECT * FROM day_targets d WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE t.channel = d.channel
            AND date_trunc('month', t.order_date) = d.month)""",
        "open_days": """SELECT *, CAST(month + n AS DATE) AS order_date, CASE WHEN channel IN ('signup', 'fair') THEN 'Marketplace'
              ELSE 'Offline' END AS source_channel FROM open_months CROSS JOIN (SELECT CAST(unnest(range(0, 31)) AS INTEGER) AS n)
            WHERE n < days_in_month AND month + n <= DATE '2024-02-09'""",
        "allocated": f"""SELECT {_DIMS}, daily_target * coalesce(sku_contribution_pct, 0) AS gmv,
              daily_target * coalesce(sku_contribution_pct, 0) AS gross_sales,
              daily_units_target * coalesce(sku_units_contribution_pct, 0) AS units_sold, 1 AS is_projected
            FROM open_days JOIN shares USING (channel)
            UNION ALL SELECT 'FIRST', NULL, source_channel, channel, order_date, NULL, NULL, NULL, NULL, NULL, 'null',
              daily_target, daily_target, daily_units_target, 1
            FROM open_days WHERE channel NOT IN (SELECT channel FROM shares)""",
        "rows": f"""SELECT {_DIMS}, gmv, gross_sales, units_sold FROM rolled UNION ALL
            SELECT {_DIMS}, gmv, gross_sales, units_sold FROM tgt UNION ALL
            SELECT {_DIMS}, gmv, gross_sales, units_sold FROM allocated""",
    }


def steps(cte: dict[str, str], last: str) -> str:
    names = list(cte)[: list(cte).index(last) + 1]
    return "WITH " + ",\n".join(f"{n} AS ({cte[n]})" for n in names)


def rollup(src: str) -> str:
    return f"""SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, {_ITEM}, max(order_date) AS max_date, {each(total)}
        FROM {src} GROUP BY ALL"""


def allocation(src: str) -> str:
    order = ", ".join(f"{t} NULLS FIRST" for t in TIES)
    return f"""SELECT a.* EXCLUDE (rn), CASE WHEN rn = 1 AND brand = 'FIRST' THEN t END AS final_product_target,
          CASE WHEN rn = 1 AND brand = 'FIRST' THEN t / day(last_day(a.month)) END AS product_target
        FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(KEYS)} ORDER BY {order}) AS rn FROM {src}) a
        LEFT JOIN (SELECT month, channel, nullif(main_category, '#N/A') AS c, nullif(product_title, '#N/A') AS p,
          {total('final_product_target')} AS t FROM in_product_targets GROUP BY 1, 2, 3, 4) b
        ON a.month = b.month AND a.channel = b.channel AND main_category = c AND product_title = p"""


def lmtd(src: str) -> str:
    return f"""SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, {', '.join(plan.LMTD_KEYS)},
        {total('gross_sales')} AS lmtd_gross FROM {src}
        WHERE date_trunc('month', order_date) = DATE '2024-01-01' AND day(order_date) <= 9 GROUP BY ALL"""


_EVERY = chain("TRUE", _TARGETED)
_FIRST = chain("TRUE", f"brand = 'FIRST' AND {_TARGETED}")
_REPORT = chain(f"NOT (brand = 'FIRST' AND {_TARGETED})", f"brand = 'FIRST' AND {_TARGETED}")
_SAME = " AND ".join(f"r.{k} = l.{k}" for k in plan.LMTD_KEYS)

ORACLE = {
    "daily_agg": oracle(_EVERY["daily"]),
    "trailing_mean": oracle(steps(_EVERY, "means") + " SELECT * FROM means"),
    "future_dates": oracle(steps(_EVERY, "dates") + " SELECT * FROM dates"),
    "project_flat": oracle(steps(_EVERY, "flat") + " SELECT * FROM flat"),
    "rolling_projection": oracle(steps(_EVERY, "rolled") + " SELECT * FROM rolled"),
    "unpivot_targets": oracle(steps(_EVERY, "targets") + f"""
        SELECT t.*, sold FROM targets t LEFT JOIN (SELECT channel, CAST(date_trunc('month', order_date) AS DATE) AS month,
          {total('gmv')} AS sold FROM tgt GROUP BY 1, 2) USING (channel, month)"""),
    "daily_target": oracle(steps(_FIRST, "day_targets") + " SELECT * FROM day_targets"),
    "contribution_share": oracle(
        steps(_EVERY, "shares") + " SELECT * RENAME (g AS sku_monthly_gmv, u AS sku_monthly_units) FROM shares"
    ),
    "allocate_target": oracle(steps(_FIRST, "allocated") + " SELECT * FROM allocated"),
    "month_rollup": oracle(f"{steps(_EVERY, 'daily')} {rollup('daily')}"),
    "last_month_to_date": oracle(f"{steps(_EVERY, 'daily')} {lmtd('daily')}"),
    "target_allocation": oracle(f"{steps(_EVERY, 'daily')}, months AS ({rollup('daily')}) {allocation('months')}"),
    "sales_report": oracle(f"""{steps(_REPORT, 'rows')}, months AS ({rollup('rows')}), r AS ({allocation('months')}),
        l AS ({lmtd('rows')}) SELECT r.*, lmtd_gross FROM r LEFT JOIN l
        ON r.month = l.month + INTERVAL '1' MONTH AND {_SAME}"""),
}
