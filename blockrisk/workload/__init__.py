"""Registered queries: the package's operators run over the given tables, with their SQL twins."""

from __future__ import annotations

import importlib

MODULES = ["cleaning", "geography", "panels", "models"]


def load():
    """(queries, SQL) with every module's registrations."""
    for name in MODULES:
        importlib.import_module(f"blockrisk.workload.{name}")
    from blockrisk.workload import registry

    return registry.QUERIES, registry.ORACLES
