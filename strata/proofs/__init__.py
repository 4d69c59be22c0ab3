"""Registry of runnable demonstrations on the driver's tables.

Each entry maps a SURVEY operator ID to ``fn(spark, sf_dir) -> DataFrame`` and,
where SQL can express it, the equivalent DuckDB SQL over the same tables
(views ``orders``, ``lineitem``...). Output columns are lower-case and aliased
identically on both sides; floating results are rounded on both sides."""

from __future__ import annotations

import importlib
from collections.abc import Callable

REGISTRY: dict[str, tuple[Callable, str | None]] = {}

_MODULES = ["tickets", "scalars", "relational", "history", "rules_er", "analytics", "io", "jobs"]


def proof(qid: str, sql: str | None = None):
    def deco(fn):
        if qid in REGISTRY:
            raise ValueError(f"duplicate proof id {qid}")
        REGISTRY[qid] = (fn, sql)
        return fn
    return deco


_LOADED = False


def load_all() -> dict[str, tuple[Callable, str | None]]:
    global _LOADED
    if _LOADED:
        return REGISTRY
    for m in _MODULES:
        importlib.import_module(f"{__name__}.{m}")
    _LOADED = True
    from .analytics import register_udf_surface
    register_udf_surface()
    return REGISTRY
