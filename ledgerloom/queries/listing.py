"""Listing observations from collected pages."""

from datetime import date

from pyspark.sql import functions as F

from ..operators import listing as o
from .standins import oracle, register, table

# a mobile host in the footer stands for the seller, a link for the price; the second visit
# reads another link
SELLER, PRICE, RETRY_SELLER = (
    r"<footer>&copy; (m\.[a-z.-]+) &middot;",
    r'<li><a href="/(th[a-z]+)">',
    r'<li><a href="/(a[a-z]+)">',
)
OURS = "M.Casino-Win.example.com"

register(
    {
        "in_pages": """
            SELECT page_id, url, CASE WHEN url LIKE '%#top' THEN NULL ELSE html END AS html,
              CASE WHEN url LIKE '%page=2%' THEN 'timeout' END AS error,
              CASE WHEN url LIKE 'https%' THEN 'A' ELSE 'B' END AS brand FROM {pages}"""
    }
)


def _first(spark, sf):
    return o.listing_status(table(spark, sf, "in_pages"), SELLER, PRICE, error="error").select(
        "page_id", "url", "brand", "seller_name"
    )


def _retry(spark, sf):
    """A second visit of the failed pages of one brand that also reads the pages missed before."""
    failed = _first(spark, sf).where(F.col("seller_name").isin(*o.FAILURES)).select("page_id")
    again = table(spark, sf, "pages").join(failed, "page_id", "left_semi")
    again = o.listing_status(again, RETRY_SELLER, PRICE).where(F.col("url").like("https%"))
    return again.select("page_id", F.concat(F.lit("retry:"), "url").alias("url"), "seller_name")


def retry_merge(spark, sf):
    return o.retry_merge(_first(spark, sf), _retry(spark, sf), "page_id")


def _observed(spark, sf):
    seen = _first(spark, sf)
    return seen.withColumn("seller_name", F.nullif("seller_name", F.lit(o.NOT_VISITED)))


def seller_exclusion(spark, sf):
    return o.seller_exclusion(_observed(spark, sf), OURS, by=["brand"])


def outcome_counts(spark, sf):
    return o.outcome_counts(_observed(spark, sf), by=["brand"])


def report_date(spark, sf):
    """By a date-named column, by the first timestamp, and by the default."""
    named = table(spark, sf, "orders").select(F.col("o_orderdate").alias("report_date"), "o_orderkey")
    cases = {
        "named": o.report_date(named),
        "timestamp": o.report_date(table(spark, sf, "events")),
        "default": o.report_date(table(spark, sf, "customer"), default=date(2024, 3, 1)),
        "none": o.report_date(table(spark, sf, "customer")),
    }
    parts = [df.withColumn("case", F.lit(name)) for name, df in cases.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


QUERIES = {
    "listing_status": _first,
    "retry_merge": retry_merge,
    "seller_exclusion": seller_exclusion,
    "outcome_counts": outcome_counts,
    "report_date": report_date,
}


def _status(seller: str, error: str = "error") -> str:
    return f"""CASE WHEN {error} IS NOT NULL THEN 'N/A - Error Occurred' WHEN html IS NULL THEN 'N/A - Failed to Scrape'
      WHEN regexp_matches(html, '{seller}') THEN trim(regexp_extract(html, '{seller}', 1))
      WHEN regexp_matches(html, '{PRICE}') THEN 'OUT_OF_STOCK_PRICE: ' || trim(regexp_extract(html, '{PRICE}', 1))
      ELSE 'N/A - Data Not Found' END"""


_FIRST = f"SELECT page_id, url, brand, {_status(SELLER)} AS seller_name FROM in_pages"
_SEEN = f"SELECT brand, nullif(seller_name, 'N/A - Failed to Scrape') AS s FROM ({_FIRST})"

ORACLE = {
    "listing_status": oracle(_FIRST),
    "retry_merge": oracle(f"""
        WITH first AS ({_FIRST}), again AS (SELECT page_id, 'retry:' || url AS u, {_status(RETRY_SELLER, 'NULL')} AS s FROM pages
          WHERE url LIKE 'https%')
        SELECT page_id, CASE WHEN seller_name LIKE 'N/A - %' AND u IS NOT NULL THEN u ELSE url END AS url, brand,
          CASE WHEN seller_name LIKE 'N/A - %' AND u IS NOT NULL THEN s ELSE seller_name END AS seller_name
        FROM first LEFT JOIN again USING (page_id)"""),
    "seller_exclusion": oracle(f"""
        SELECT brand, count(*) AS observations, count(*) FILTER (s IS NULL OR lower(s) <> 'm.casino-win.example.com') AS by_others
        FROM ({_SEEN}) GROUP BY 1"""),
    "outcome_counts": oracle(f"""
        SELECT brand, count(*) FILTER (s IS NULL OR NOT contains(s, 'N/A -')) AS succeeded,
          count(*) FILTER (contains(s, 'N/A -')) AS failed FROM ({_SEEN}) GROUP BY 1"""),
    "report_date": """
        SELECT 'named' AS "case", strftime(max(o_orderdate), '%Y-%m-%d') AS report_date FROM orders
        UNION ALL SELECT 'timestamp', strftime(max(ts), '%Y-%m-%d') FROM events
        UNION ALL SELECT 'default', '2024-03-01' UNION ALL SELECT 'none', NULL""",
}
