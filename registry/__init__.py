"""Named queries over the test tables, and the SQL each is checked against."""

from __future__ import annotations

from importlib import import_module

MODULES = ["silver", "gold", "ingest", "checks", "planned", "changes", "tables"]


def load():
    """(queries, oracles): all registered callables and the assembled SQL texts."""
    from registry import core

    for name in MODULES:
        import_module(f"registry.{name}")
    return dict(core.QUERIES), {k: core.assemble(v) for k, v in core.ORACLES.items()}
