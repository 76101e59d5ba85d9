"""The queries of the library, by name."""

from __future__ import annotations


def load():
    """(queries, SQL) of every module of plans."""
    from factloom.plans import clusters, facts, places, registry, release, research, review, shapes, street_pairs, text  # noqa: F401

    return registry.QUERIES, registry.SQL
