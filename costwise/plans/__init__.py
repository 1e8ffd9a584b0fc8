"""Registered queries on the driver tables (Spark builder + DuckDB oracle SQL)."""

from __future__ import annotations

from .registry import QUERIES, Query


def all_queries() -> dict[str, Query]:
    # importing the plan modules registers their queries
    from . import (ageing, allocation, bom, controls, costing, costs, dated, gl, ledger, masters, prices, products,  # noqa: F401
                   production, reports, stock, versions)
    return dict(QUERIES)
