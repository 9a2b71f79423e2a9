"""All registered queries of the library proper, with their DuckDB texts."""

from __future__ import annotations

from importlib import import_module

from quarrystone.plans.catalog import QUERIES, SQL

PLANS = ["cleaning", "fairness", "masking", "combining", "reports", "fidelity", "storing"]
for _name in PLANS:
    import_module(f"quarrystone.plans.{_name}")


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
