"""All registered queries and the SQL they are checked against."""

from __future__ import annotations

from importlib import import_module

MODULES = ["qa", "profile", "text", "evaluation", "sequence", "models"]


def _merged(name: str) -> dict:
    found: dict = {}
    for module in MODULES:
        part = getattr(import_module(f"tabloom.catalogue.{module}"), name)
        clash = found.keys() & part.keys()
        if clash:
            raise ValueError(f"registered twice: {sorted(clash)}")
        found.update(part)
    return found


def queries() -> dict:
    return _merged("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _merged("SQL")
