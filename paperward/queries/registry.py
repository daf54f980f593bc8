"""Pairing queries with their SQL."""

from __future__ import annotations


def registry():
    """Empty query and oracle tables, and the decorator that fills them."""
    queries, oracles = {}, {}

    def query(oracle: str | None = None):
        def register(fn):
            queries[fn.__name__] = fn
            if oracle:
                oracles[fn.__name__] = oracle
            return fn

        return register

    return queries, oracles, query
