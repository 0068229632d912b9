"""Registered queries: each a Spark callable and, where SQL can say it, its check SQL."""

from __future__ import annotations

from importlib import import_module

FAMILIES = (
    "fields",
    "anomalies",
    "consistency",
    "cross",
    "revisions",
    "repairs",
    "dictionaries",
    "coverage",
    "watermarks",
    "monitoring",
    "storage",
    "loads",
)


def _collect(attr: str) -> dict:
    merged: dict = {}
    for family in FAMILIES:
        merged.update(getattr(import_module(f"{__name__}.{family}").REGISTRY, attr))
    return merged


def all_queries() -> dict:
    return _collect("queries")


def all_oracles() -> dict[str, str]:
    return _collect("oracles")
