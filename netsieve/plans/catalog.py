"""Registry of catalog queries: key -> (spark, sf_dir) -> DataFrame, plus oracle SQL.

Each ``q_*`` module registers its queries on import.  Oracle SQL is DuckDB text over the
driver's pre-registered tables; fixtures (flows, predictions, flows_signal) are added as
CTEs.  Computed doubles are rounded to 6 places on both sides, since summation order
differs between engines.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from ..fixtures import with_fixtures

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}

_MODULES = ["q_features", "q_aggregates", "q_sampling", "q_prep", "q_evaluate",
            "q_models", "q_sources", "q_stream"]


def positive_zero_rounds(sql: str) -> str:
    """Wrap every ``round(...)`` as ``case when round(...) = 0 then 0.0 else round(...) end``:
    DuckDB rounds a tiny negative to -0.0 where Spark gives 0.0, and the two zeros hash
    differently."""
    out, i, low = [], 0, sql.lower()
    while True:
        j = low.find("round(", i)
        if j < 0 or (j > 0 and (low[j - 1].isalnum() or low[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k = 0, j + 5
        while k < len(sql):
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        expr = sql[j:k + 1]
        out.append(sql[i:j])
        out.append(f"(case when {expr} = 0 then 0.0 else {expr} end)")
        i = k + 1


def register(key: str, sql: str | None = None, fixtures: tuple = ()):
    def deco(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = with_fixtures(positive_zero_rounds(sql), *fixtures)
        return fn
    return deco


def load_all() -> None:
    for m in _MODULES:
        importlib.import_module(f"{__package__}.{m}")


def queries() -> dict[str, Callable]:
    load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    load_all()
    return dict(ORACLE)
