"""Config-driven projection of landing rows to typed columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from tidemark.sources.config import ConfigError
from tidemark.sources.mappings import Mapping

HEADER = ("raw_id", "extracted_at")


def active_mappings(mappings: Iterable[Mapping]) -> list[Mapping]:
    """Active mappings in projection order; an inactive one makes its column disappear."""
    rows = list(mappings)
    retired = [m.target_column for m in rows if m.is_required and not m.is_active]
    if retired:
        raise ConfigError(f"required fields are inactive: {', '.join(retired)}")
    return sorted((m for m in rows if m.is_active), key=lambda m: m.ordinal)


def field_expr(m: Mapping) -> str:
    return f"cast({m.source_expr} as {m.data_type})" if m.data_type else f"({m.source_expr})"


def build_staging(landing: DataFrame, mappings: Iterable[Mapping]) -> DataFrame:
    """Landing header plus one typed column per active mapping; lazy, never stored."""
    fields = [f"{field_expr(m)} as `{m.target_column}`" for m in active_mappings(mappings)]
    return landing.selectExpr(*HEADER, *fields)
