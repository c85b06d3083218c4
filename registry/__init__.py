"""The registered queries and, where SQL can express them, their DuckDB twins."""

from . import aggregates, cleaning, enrichment, features, flows, quality, storage, trips

MODULES = (cleaning, features, aggregates, trips, quality, enrichment, storage, flows)


def all_queries():
    return {name: case[0] for module in MODULES for name, case in module.CASES.items()}


def all_oracles():
    return {name: case[1] for module in MODULES for name, case in module.CASES.items() if case[1]}
