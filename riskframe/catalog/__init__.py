"""Registered queries and their reference SQL, by module."""

from __future__ import annotations

from importlib import import_module

MODULES = ["fairness", "evaluation", "quality", "profile", "sampling", "features", "training", "significance",
           "explanation", "sources"]


def _gather(attribute: str) -> dict:
    out: dict = {}
    for name in MODULES:
        found = getattr(import_module(f"riskframe.catalog.{name}"), attribute)
        clash = out.keys() & found.keys()
        if clash:
            raise ValueError(f"registered twice: {sorted(clash)}")
        out.update(found)
    return out


def queries() -> dict:
    return _gather("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _gather("ORACLE")
