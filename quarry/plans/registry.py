"""All registered queries and their oracle SQL."""

from __future__ import annotations

import importlib

# plan modules, each exporting QUERIES (and ORACLE for SQL-expressible keys)
MODULES = [
    "quarry.plans.suite",
    "quarry.plans.declared",
    "quarry.plans.preprocess",
    "quarry.plans.basics",
    "quarry.plans.stats",
    "quarry.plans.analysis",
    "quarry.plans.feeds",
]


def _load():
    queries, oracle = {}, {}
    for name in MODULES:
        mod = importlib.import_module(name)
        for k, fn in mod.QUERIES.items():
            if k in queries:
                raise ValueError(f"duplicate query key {k}")
            queries[k] = fn
        oracle.update(getattr(mod, "ORACLE", {}))
    missing = set(oracle) - set(queries)
    if missing:
        raise ValueError(f"oracle without query: {sorted(missing)}")
    return queries, oracle


def queries():
    return _load()[0]


def oracle_sql():
    return _load()[1]
