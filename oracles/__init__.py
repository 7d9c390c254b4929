"""DuckDB counterparts of the registered queries, written apart from the engine."""

from __future__ import annotations

from oracles import dashboard, layers, medallion, semantic

__all__ = ["texts"]


def texts() -> dict[str, str]:
    bodies = medallion.TEXTS | dashboard.TEXTS | semantic.TEXTS
    return {name: f"{layers.ALL_LAYERS}\n{body}" for name, body in bodies.items()}
