"""Every operator as a query over the given tables, with the SQL it must agree with."""

from . import clean, forecast, listing, pnl, pricing, projection, recon, sales, tables, tracking

MODULES = [clean, pricing, pnl, recon, sales, projection, tracking, forecast, listing, tables]


def all_queries() -> dict:
    return {name: fn for m in MODULES for name, fn in m.QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.ORACLE.items()}
