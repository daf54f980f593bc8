"""Registered queries, each with the SQL that checks it where SQL can."""

from __future__ import annotations

import importlib

AREAS = ("text", "network", "cases", "reports", "intake", "streams")


def _collect(what: str) -> dict:
    out: dict = {}
    for area in AREAS:
        out.update(getattr(importlib.import_module(f"{__name__}.{area}"), what))
    return out


def all_queries() -> dict:
    return _collect("QUERIES")


def all_oracles() -> dict:
    return _collect("ORACLES")
