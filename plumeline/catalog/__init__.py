"""Registered queries and oracles, merged over the topic modules."""

from __future__ import annotations

from functools import wraps
from importlib import import_module

from plumeline.session import prepare

MODULES = ("mart_queries", "merge_queries", "feed_queries", "store_queries")


def _merged(attribute: str) -> dict:
    merged: dict = {}
    for name in MODULES:
        merged.update(getattr(import_module(f"{__name__}.{name}"), attribute))
    return merged


def _prepared(query):
    @wraps(query)
    def run(spark, sf_dir):
        return query(prepare(spark), sf_dir)

    return run


def queries() -> dict:
    return {name: _prepared(query) for name, query in _merged("QUERIES").items()}


def oracles() -> dict:
    return _merged("ORACLES")
