"""Who sells a listing: from collected pages to daily observations."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Labels of an observation without a seller, and date column names.
NOT_VISITED = "N/A - Failed to Scrape"
NOT_FOUND = "N/A - Data Not Found"
FAILED = "N/A - Error Occurred"
FAILURES = [NOT_VISITED, NOT_FOUND, FAILED]
FAILURE_MARK = "N/A -"
PRICE_PREFIX = "OUT_OF_STOCK_PRICE: "
DATE_COLUMNS = ["date", "Date", "DATE", "created_date", "report_date", "Report_Date"]


def listing_status(
    pages: DataFrame,
    seller_pattern: str,
    price_pattern: str,
    html: str = "html",
    error: str | None = None,
    out: str = "seller_name",
) -> DataFrame:
    """Add the seller found on a page, else the out-of-stock price, else why there is none.

    Each pattern has one group.  A page that was never fetched has neither text nor error.
    """
    def found(pattern: str) -> Column:
        hit = F.regexp_extract(html, pattern, 1)
        return F.when(F.col(html).rlike(pattern), F.trim(hit))

    seller, price = found(seller_pattern), found(price_pattern)
    rules = F.when(F.col(error).isNotNull(), FAILED) if error else F.when(F.lit(False), FAILED)
    status = (
        rules.when(F.col(html).isNull(), NOT_VISITED)
        .when(seller.isNotNull(), seller)
        .when(price.isNotNull(), F.concat(F.lit(PRICE_PREFIX), price))
        .otherwise(NOT_FOUND)
    )
    return pages.withColumn(out, status)


def retry_merge(
    first: DataFrame,
    retry: DataFrame,
    key: str,
    status: str = "seller_name",
    failed: Sequence[str] = FAILURES,
) -> DataFrame:
    """Rows of the first pass; a failed one is replaced by its retry, even one that failed too."""
    second = retry.select(
        F.col(key).alias("_key"), F.struct(*[c for c in retry.columns if c != key]).alias("_retry")
    )
    use = F.col(status).isin(*failed) & F.col("_retry").isNotNull()
    joined = first.join(second, F.col(key) == F.col("_key"), "left").withColumn(
        "_use", F.coalesce(use, F.lit(False))
    )
    return joined.select(
        *[
            F.when(F.col("_use"), F.col(f"_retry.{c}")).otherwise(F.col(c)).alias(c)
            if c != key and c in retry.columns
            else F.col(c)
            for c in first.columns
        ]
    )


def others_sell(col: str, seller: str) -> Column:
    """Not our seller, whatever the case; unknown counts as not ours."""
    return F.coalesce(F.lower(col) != seller.lower(), F.lit(True))


def seller_exclusion(
    df: DataFrame, seller: str, col: str = "seller_name", by: Sequence[str] = ()
) -> DataFrame:
    """Observations before and after removing our own seller, per ``by``."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("observations"),
        F.count_if(others_sell(col, seller)).alias("by_others"),
    )


def outcome_counts(
    df: DataFrame, col: str = "seller_name", marker: str = FAILURE_MARK, by: Sequence[str] = ()
) -> DataFrame:
    """Successful and failed observations; an unknown seller counts as success."""
    failed = F.coalesce(F.contains(F.col(col), F.lit(marker)), F.lit(False))
    return df.groupBy(*by).agg(
        F.count_if(~failed).alias("succeeded"), F.count_if(failed).alias("failed")
    )


def report_date(
    df: DataFrame, candidates: Sequence[str] = DATE_COLUMNS, default: date | None = None
) -> DataFrame:
    """Freshness of a report as ``yyyy-MM-dd``.

    The latest value of the first date-named column, else of the first timestamp column,
    else ``default``; names are matched with their case.
    """
    names = [c for c in candidates if c in df.columns]
    names = names or [
        f.name for f in df.schema if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))
    ]
    fallback = F.lit(default.isoformat() if default else None).cast("string")
    latest = F.max(F.to_date(names[0]) if names else F.lit(None).cast("date"))
    return df.agg(F.coalesce(F.date_format(latest, "yyyy-MM-dd"), fallback).alias("report_date"))
