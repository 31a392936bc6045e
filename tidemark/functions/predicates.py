"""Row predicates of the merge (operators D4, D6, D7, D10)."""

from __future__ import annotations

import functools
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_delete(flag: Column) -> Column:
    """Delete marker; a NULL flag means 'not deleted'."""
    return F.coalesce(flag, F.lit(False))


def compare_columns(source_cols: Sequence[str], target_cols: Iterable[str],
                    key: Iterable[str], excluded: Iterable[str],
                    ignored: Iterable[str]) -> list[str]:
    """Columns compared to decide 'changed': source columns present in the
    target, minus key, excluded and ignored columns (all case-insensitive)."""
    drop = {c.lower() for c in [*key, *excluded, *ignored]}
    tgt = {c.lower() for c in target_cols}
    return [c for c in source_cols if c.lower() not in drop and c.lower() in tgt]


def rows_differ(pairs: Sequence[tuple[Column, Column]]) -> Column:
    """True when any pair differs, NULL-safe and exact per column.

    A hash over all columns would miss a value moving between two columns
    next to a NULL; the per-column null-safe equality does not.
    """
    if not pairs:
        return F.lit(False)
    same = functools.reduce(lambda a, b: a & b, [s.eqNullSafe(t) for s, t in pairs])
    return ~same


def check_passes(condition: Column) -> Column:
    """A row passes a CHECK only when the condition is true (NULL fails)."""
    return F.coalesce(condition, F.lit(False))
