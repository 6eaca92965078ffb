"""Compositions of the operators, and the catalogue of named queries."""

from __future__ import annotations


def _load():
    from panelcast.plans import catalog
    # Importing a module registers its queries.
    from panelcast.plans import core_queries, model_queries, state_queries  # noqa: F401
    return catalog


def all_queries():
    return dict(_load().QUERIES)


def all_oracles():
    return dict(_load().ORACLES)
