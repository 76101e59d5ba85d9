"""Training-data operators: one module each, and the queries that apply them to the driver's tables."""

from __future__ import annotations


def queries():
    from factloom.llm import registry

    return registry.queries()


def oracle_sql():
    from factloom.llm import registry

    return registry.oracle_sql()
