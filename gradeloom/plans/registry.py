"""All registered queries of the core, and the SQL they are checked against."""

from __future__ import annotations

from . import corpus, evaluation, nested, rules

FLAGSHIP = "eval_slices"
_MODULES = (corpus, evaluation, nested, rules)


def queries() -> dict:
    return {k: f for m in _MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in _MODULES for k, s in m.SQL.items()}
