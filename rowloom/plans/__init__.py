"""Ready-made queries over the standard tables, each with its SQL counterpart."""

from __future__ import annotations

from importlib import import_module

_AREAS = ("text", "tables", "scores", "fits")


def _collect(name: str) -> dict:
    found: dict = {}
    for area in _AREAS:
        found |= getattr(import_module(f"{__name__}.{area}"), name)
    return found


def queries() -> dict:
    return _collect("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _collect("SQL")
