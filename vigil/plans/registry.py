"""All registered driver queries and their oracle SQL."""

from __future__ import annotations

from vigil.plans import (
    oracle_eval,
    oracle_features,
    oracle_jobs,
    oracle_stream,
    oracle_windows,
    queries_eval,
    queries_features,
    queries_jobs,
    queries_stream,
    queries_windows,
)


def all_queries() -> dict:
    out = {}
    for mod in (queries_features, queries_eval, queries_windows, queries_stream, queries_jobs):
        out.update(mod.QUERIES)
    return out


def all_oracles() -> dict:
    out = {}
    for mod in (oracle_features, oracle_eval, oracle_windows, oracle_stream, oracle_jobs):
        out.update(mod.ORACLE)
    return out
