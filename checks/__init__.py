"""Registered queries: each operator run on the test tables, next to its oracle SQL."""

import importlib

MODULES = ("q_flagship", "q_sources", "q_joins", "q_aggregates", "q_scalars", "q_jobs", "q_models", "q_streams")


def load_all() -> None:
    for name in MODULES:
        importlib.import_module(f".{name}", __name__)
