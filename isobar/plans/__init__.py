"""Registered queries of the library and their DuckDB SQL: each applies one operator to a whole table."""

from __future__ import annotations

from . import consensus, feeds, grids, hazards, learning, products

_PLANS = (consensus, learning, grids, hazards, feeds, products)


def queries() -> dict:
    return {k: q for p in _PLANS for k, (q, _) in p.PLANS.items()}


def oracle_sql() -> dict[str, str]:
    return {k: sql for p in _PLANS for k, (_, sql) in p.PLANS.items() if sql}
