"""Named queries: each binds an operation to the shared tables.

A rendition is registered with its DuckDB text next to it, so that the two
readings of one question sit side by side.  ``sql=None`` marks work that SQL
cannot express (training, writing models).
"""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from quarrymill.tables import Tables

_SECTIONS = (
    "sources", "project", "joins", "aggregates", "ordered", "topk", "sets",
    "scalars", "features", "resample", "permute", "graph", "models", "metrics",
    "streams",
)
_RENDITIONS: dict[str, Callable[[Tables], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a rendition under ``name``."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in _RENDITIONS:
            raise ValueError(f"query {name} is registered twice")
        _RENDITIONS[name] = fn
        if sql is not None:
            _ORACLES[name] = sql
        return fn

    return register


def _load() -> None:
    for section in _SECTIONS:
        import_module(f"{__name__}.{section}")


def renditions() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()

    def bind(fn):
        return lambda spark, folder: fn(Tables(spark, folder))

    return {name: bind(fn) for name, fn in _RENDITIONS.items()}


def oracles() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
