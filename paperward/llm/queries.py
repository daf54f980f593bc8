"""Registered queries of this subpackage, each with its SQL where SQL can say it."""

from __future__ import annotations

import importlib

AREAS = ("shard_queries", "neardup_queries", "jaccard_queries", "substring_queries", "quality_queries", "license_queries", "token_queries", "crf_queries", "topk_queries", "periodic_queries", "spelling_queries")


def _collect(what: str) -> dict:
    out: dict = {}
    for area in AREAS:
        out.update(getattr(importlib.import_module(f"paperward.llm.{area}"), what))
    return out


def all_queries() -> dict:
    return _collect("QUERIES")


def all_oracles() -> dict:
    return _collect("ORACLES")
