"""Independent SQL of the registered queries, for checking results in another engine."""

from __future__ import annotations

import importlib

from oracle.prelude import sql

FAMILIES = ("views", "customers", "delivery", "restaurants", "operations", "executive", "questions", "reports", "kpis", "quality", "requests", "streaming", "storage")


def all_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for family in FAMILIES:
        out.update({name: sql(body) for name, body in importlib.import_module(f"oracle.{family}").SQL.items()})
    return out
