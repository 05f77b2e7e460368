"""Queries of the subpackage and their SQL, by name."""

from __future__ import annotations

from . import queries_index, queries_native, queries_near, queries_text

_MODULES = [queries_native, queries_near, queries_text, queries_index]


def queries() -> dict:
    import corpus_pipeline

    return {k: v for m in _MODULES for k, v in m.QUERIES.items()} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict:
    return {k: v for m in _MODULES for k, v in m.SQL.items()}
