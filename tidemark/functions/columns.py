"""Case-insensitive column lookup (Spark resolves names case-insensitively)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


def find_column(df_or_names: DataFrame | Iterable[str], name: str) -> str | None:
    """Actual name of ``name`` in the frame, ignoring case; None if absent."""
    names = df_or_names.columns if isinstance(df_or_names, DataFrame) else list(df_or_names)
    low = name.lower()
    for n in names:
        if n.lower() == low:
            return n
    return None


def has_column(df_or_names, name: str) -> bool:
    return find_column(df_or_names, name) is not None


def lower_set(names: Iterable[str]) -> set[str]:
    return {n.lower() for n in names}
