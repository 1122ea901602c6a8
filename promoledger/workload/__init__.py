"""Registered queries over the star-schema test tables."""

from __future__ import annotations

from importlib import import_module

MODULES = ("relational", "reports", "writes", "quality", "policies", "layouts", "streams")


def _merged(attribute: str) -> dict:
    merged: dict = {}
    for name in MODULES:
        part = getattr(import_module(f"promoledger.workload.{name}"), attribute)
        clash = merged.keys() & part.keys()
        if clash:
            raise ValueError(f"query names used twice: {sorted(clash)}")
        merged.update(part)
    return merged


def all_queries() -> dict:
    return _merged("QUERIES")


def all_oracles() -> dict:
    return _merged("ORACLE")
