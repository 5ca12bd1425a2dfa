"""Registered queries: every operator over the given tables, with its SQL."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a builder; ``sql`` is the same question for an ANSI database."""

    def register(build: Builder) -> Builder:
        key = name or build.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = build
        if sql is not None:
            ORACLES[key] = sql
        return build

    return register


def load_all() -> None:
    for part in ("ingest", "documents", "model", "vectors", "quality", "expressions"):
        import_module(f"docengine.catalog.{part}")
