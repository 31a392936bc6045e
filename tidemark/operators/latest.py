"""Latest version per record key (operator G1).

``row_number() = 1`` over ``partition by key order by versions desc nulls
last`` is planned by Spark as a *partial* WindowGroupLimit on the map side,
an exchange on the key, and a final WindowGroupLimit.  Each map task thus
keeps at most one row per key before the shuffle, so a hot key (including
the single group of NULL keys) shrinks to one row per input partition
instead of landing whole in one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from tidemark.config import VERSION_ORDER
from tidemark.functions.columns import find_column

_RANK = "__rank"


def _resolve(df: DataFrame, names: Sequence[str], required: bool) -> list[str]:
    out = []
    for n in names:
        c = find_column(df, n)
        if c is None:
            if required:
                raise ValueError(f"column {n!r} not found in {df.columns}")
            continue
        out.append(c)
    return out


def latest_version(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                   tiebreak: bool = True) -> DataFrame:
    """Keep one row per ``keys``: the first by ``order`` (each descending,
    NULLs last).  With ``tiebreak`` the remaining columns are appended to the
    order so the pick is deterministic; without it ties are arbitrary.
    NULL keys form one group, as in SQL window partitioning."""
    key_cols = _resolve(df, keys, required=True)
    order_cols: list[Column] = []
    used = {k.lower() for k in key_cols}
    for o in order:
        if isinstance(o, Column):
            order_cols.append(o)
            continue
        c = find_column(df, o)
        if c is not None:
            order_cols.append(F.col(c).desc_nulls_last())
            used.add(c.lower())
    if tiebreak:
        order_cols += [F.col(f.name).desc_nulls_last() for f in df.schema.fields
                       if f.name.lower() not in used and not isinstance(f.dataType, MapType)]
    w = Window.partitionBy(*[F.col(k) for k in key_cols]).orderBy(*order_cols)
    return df.withColumn(_RANK, F.row_number().over(w)).filter(F.col(_RANK) == 1).drop(_RANK)


def latest_change(df: DataFrame, key: Sequence[str], version_order: Sequence[str] = VERSION_ORDER,
                  extra_order: Sequence[str | Column] = ()) -> DataFrame:
    """G1 with the exporter's version order (missing version columns skipped),
    then ``extra_order`` (e.g. the landing folder), then a total tiebreak."""
    return latest_version(df, key, [*version_order, *extra_order], tiebreak=True)
