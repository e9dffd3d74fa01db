"""Cleaning of identifiers that arrive as messy text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_id(
    col: Column | str,
    strip: Sequence[str] = ("backtick", "quote", ".0"),
    null_words: Sequence[str] = ("nan", ""),
) -> Column:
    """Remove export artefacts from an id; an id that is only a null word becomes NULL.

    ``strip`` may name ``backtick`` (all of them), ``leading_backtick``, ``quote`` (both
    ends) and ``.0`` (a trailing float suffix).
    """
    out = _col(col)
    if "backtick" in strip:
        out = F.replace(out, F.lit("`"), F.lit(""))
    if "leading_backtick" in strip:
        out = F.regexp_replace(out, "^`", "")
    if "quote" in strip:
        out = F.btrim(out, F.lit('"'))
    if ".0" in strip:
        out = F.regexp_replace(out, r"\.0$", "")
    return F.when(~F.trim(out).isin(*null_words), out) if null_words else out


def pad_id(col: Column | str, width: int = 13) -> Column:
    """Left-pad with zeros; a longer id is cut to ``width``."""
    return F.lpad(_col(col), width, "0")


def null_marker(col: Column | str, marker: str = "#N/A") -> Column:
    """A spreadsheet marker becomes NULL."""
    return F.nullif(_col(col), F.lit(marker))


def spread_nulls(key: Column | str, *row_id: Column | str) -> Column:
    """A join key whose NULLs are spread over many values that match nothing.

    A left join sends all NULL keys to one task.  The replacement is a function of the
    row, so a retried task produces the same key.
    """
    salt = F.concat(F.lit("\u0001"), F.xxhash64(*[_col(c) for c in row_id]).cast("string"))
    return F.coalesce(_col(key), salt)
