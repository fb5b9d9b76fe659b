"""All queries of the core by name, and their SQL."""

from __future__ import annotations

from sampleloom.plans import date_queries, entity_queries, pipeline_queries, relational_queries, text_queries, training_data
from sampleloom.plans.folding import complete
from sampleloom.session import shipped

_MODULES = (training_data, text_queries, date_queries, relational_queries, entity_queries, pipeline_queries)


def all_queries() -> dict:
    return {k: shipped(f) for m in _MODULES for k, f in m.QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return {k: complete(s) for m in _MODULES for k, s in m.ORACLE.items()}
