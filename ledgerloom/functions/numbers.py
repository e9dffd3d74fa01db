"""Tolerant casts, and money sums that do not depend on row order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .ids import _col

MONEY = "decimal(18,4)"
FINE = "decimal(28,6)"


def safe_number(col: Column | str, type: str = "double", default=None) -> Column:
    """Cast text to a number; bad text and NaN become NULL, then ``default``."""
    out = _col(col).try_cast(type)
    if type in ("double", "float"):
        out = F.when(~F.isnan(out), out)
    return out if default is None else F.coalesce(out, F.lit(default).cast(type))


def to_int64(col: Column | str) -> Column:
    """Round half away from zero to a bigint (a bare cast would truncate)."""
    return F.round(_col(col), 0).cast("bigint")


def money(col: Column | str) -> Column:
    return _col(col).cast(MONEY)


def money_sum(col: Column | str) -> Column:
    """Exact sum of amounts to six places, as a double."""
    return F.sum(_col(col).cast(FINE)).cast("double")


def money_avg(col: Column | str) -> Column:
    """Exact sum over the non-NULL count, as a double."""
    return F.try_divide(money_sum(col), F.count(_col(col)).cast("double"))


def round_money(col: Column | str, scale: int = 2) -> Column:
    """Round half up on the decimal value, as a double."""
    return F.round(_col(col).cast(MONEY), scale).cast("double")
