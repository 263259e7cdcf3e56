"""Queries over the given tables, one per model and operator."""

from __future__ import annotations


def catalog():
    """All registered queries by name."""
    from tidemark.queries import (  # noqa: F401
        gate_on_tables,
        incremental_on_tables,
        late_on_tables,
        models_on_tables,
        operators_on_tables,
        quality_on_tables,
        stores_on_tables,
        streams_on_tables,
    )
    from tidemark.queries.registry import REGISTRY

    return dict(REGISTRY)
