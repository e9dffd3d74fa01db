"""Actual orders against a forecast."""

from datetime import date

from ..operators import forecast as f
from .standins import oracle, register, table

AS_OF = date(2024, 1, 31)
PLACES = ["click", "view", "purchase", "signup", "error"]

register(
    {
        # event types stand for places; one place has no forecast, another has gaps
        "in_forecast": "SELECT CAST(ts AS DATE) AS order_date, CASE WHEN user_id < 130 THEN 'Shopify' ELSE 'Other' END AS channel_name, "
        + ", ".join(
            f"CASE WHEN event_type = '{p}' {'AND hour(ts) > 22 ' if p == 'view' else ''}THEN value END AS {p}_actual, "
            + (f"0.0 AS {p}_projected" if p == "error" else f"CASE WHEN event_type <> '{p}' THEN value / 4 END AS {p}_projected")
            for p in PLACES
        )
        + " FROM {events}"
    }
)


def daily_wide_sum(spark, sf):
    return f.daily_wide_sum(table(spark, sf, "in_forecast"), "Shopify", AS_OF, PLACES)


def forecast_variance(spark, sf):
    return f.variance(daily_wide_sum(spark, sf), PLACES)


def forecast_accuracy(spark, sf):
    return f.forecast_accuracy(daily_wide_sum(spark, sf), 7, PLACES)


QUERIES = {
    "daily_wide_sum": daily_wide_sum,
    "forecast_variance": forecast_variance,
    "forecast_accuracy": forecast_accuracy,
}


def total(x: str) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(28,6))) AS DOUBLE)"


_COLUMNS = [f"{p}_{k}" for k in ("actual", "projected") for p in PLACES]
_WIDE = f"""SELECT order_date, {', '.join(f'{total(c)} AS {c}' for c in _COLUMNS)} FROM in_forecast
    WHERE channel_name = 'Shopify' AND date_trunc('month', order_date) = DATE '2024-01-01'
    GROUP BY 1 ORDER BY order_date DESC LIMIT 31"""
_LONG = " UNION ALL ".join(
    f"SELECT order_date, '{p}' AS place, {p}_actual AS actual, {p}_projected AS projected FROM wide" for p in PLACES
)


def _text(x: str) -> str:
    return f"""CASE WHEN round_even({x}, 0) = 0 AND {x} < 0 THEN '-0'
        ELSE coalesce(format('{{:,}}', CAST(round_even({x}, 0) AS BIGINT)), '') END"""


ORACLE = {
    "daily_wide_sum": oracle(_WIDE),
    "forecast_variance": oracle(f"""
        WITH wide AS ({_WIDE}), long AS ({_LONG}), v AS (SELECT *, actual - projected AS a_p,
          round_even(CAST(CAST(CASE WHEN projected = 0 THEN NULL ELSE (actual - projected) * 100 / projected END AS DECIMAL(18,6)) AS DOUBLE), 1)
            AS a_p_pct FROM long)
        SELECT *, strftime(order_date, '%d %b %Y') AS date_text, {_text('actual')} AS actual_text,
          {_text('projected')} AS projected_text, {_text('a_p')} AS a_p_text,
          coalesce(printf('%.1f%%', a_p_pct), '') AS a_p_pct_text,
          CASE WHEN a_p_pct < 0 THEN 'low' WHEN a_p_pct > 20 THEN 'high' END AS band FROM v"""),
    "forecast_accuracy": oracle(f"""
        WITH wide AS ({_WIDE}), long AS ({_LONG}),
        m AS (SELECT place, {total('actual')} / nullif(count(actual), 0) AS actual_mean,
            {total('projected')} / nullif(count(projected), 0) AS projected_mean
          FROM long WHERE order_date IN (SELECT order_date FROM wide ORDER BY 1 DESC LIMIT 7) GROUP BY 1)
        SELECT *, CASE WHEN projected_mean > 0 THEN (1 - abs(actual_mean - projected_mean) / projected_mean) * 100 ELSE 0 END AS accuracy
        FROM m"""),
}
