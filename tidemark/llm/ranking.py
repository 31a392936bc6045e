"""Places of rows in an order, without a single task that sees them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage


def numbered(df: DataFrame, order: list[Column | str], label: str, group: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``df`` with ``idx``, each row's place (from 0) in its group by ``order``, and the groups' sizes.

    Rows are dealt to tasks by ranges of (group, order), so a large group is spread over tasks; each task
    counts its own rows, and only these counts are added up.  ``group`` is a column without nulls, or
    None for one group; the sizes have the columns ``group`` and ``n``.  ``order`` should be total; rows that are
    equal in it are numbered in any order.  An empty table gives no rows.
    """
    free = _free_names(df, "idx", "seq", "part", "first", "below", "n_part")
    seq, part, first, below, n_part = (free[k] for k in ("seq", "part", "first", "below", "n_part"))
    keys = ([group] if group else []) + list(order)
    dealt = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(seq, F.monotonically_increasing_id())
    dealt = stage(dealt, label).withColumn(part, F.shiftright(seq, 33))
    by = [group] if group else []
    parts = dealt.groupBy(*by, part).agg(F.min(seq).alias(first), F.count(F.lit(1)).alias(n_part))
    # A row per task and group: the window's input grows with the tasks, not with the rows.
    before = Window.partitionBy(*by).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn(below, F.coalesce(F.sum(n_part).over(before), F.lit(0)))
    rows = (dealt.join(parts.drop(n_part), [*by, part])
            .withColumn("idx", F.col(seq) - F.col(first) + F.col(below)).select(*df.columns, "idx"))
    return rows, dealt.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def _free_names(df: DataFrame, *wanted: str) -> dict[str, str]:
    """Names for working columns that ``df`` doesn't have; ``idx`` must be free."""
    taken = {c.lower() for c in df.columns}
    if "idx" in taken:
        raise ValueError("idx is the result's own column")
    found = {}
    for name in wanted:
        found[name] = "_" + name
        while found[name] in taken:
            found[name] += "_"
    return found


__all__ = ["numbered"]
