"""Merge a change set into a current-state table (operators B3-B8, D5-D7, E5).

After the latest-version step every key occurs at most once in the change
set, so "upsert the non-delete rows, then delete the delete rows" equals one
join of target and source on the key (NULL-safe), with one action per row:

    keep       target row, key not in the source
    unchanged  matched, compared columns equal
    update     matched, some compared column differs (exact, NULL-safe)
    insert     source row, key not in the target, not a delete
    delete     matched delete marker        -> row removed
    ignore     delete marker for an unknown key

New state = keep + unchanged + update + insert.  The change feed is derived
from the same frame (insert, update_preimage, update_postimage, delete);
``outputs`` has both in one frame, so a load runs the join once.

Two physical strategies, same result (the load job always takes ``shuffle``,
which keeps the stored layout):

* ``shuffle``: one full outer join on the key.  When the stored table is
  bucketed by the key, only the change set is exchanged (the join keys are
  plain equalities; NULL keys go through a separate, tiny null-safe join).
* ``broadcast``: the change set is small (size checked by the caller or by
  staging it): target LEFT OUTER JOIN broadcast(source) gives keep / unchanged
  / update / delete without shuffling the target; the keys it matched
  (bounded by the source) are broadcast again to anti-join the source for
  insert / ignore.  The stored table is scanned twice, the second time only
  its key columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DecimalType, MapType, StructType

from tidemark.config import (CREATED_STAMP, DELETE_FLAG, IGNORED_COMPARE_COLUMNS,
                             PROCESSED_STAMP)
from tidemark.functions.columns import find_column
from tidemark.functions.predicates import compare_columns, is_delete, rows_differ

ACTION = "_action"
CHANGE_TYPE = "_change_type"
KIND = "_kind"
ACTIONS = ("keep", "unchanged", "update", "insert", "delete", "ignore")
STATE_ACTIONS = ("keep", "unchanged", "update", "insert")
_T, _S = "__t_", "__s_"
_TP, _SP = "__t_present", "__s_present"


@dataclass
class MergeResult:
    """Lazy outputs of one merge.  ``actions`` holds one row per joined key
    with both images and ``_action``; ``state`` and ``changes`` are separate
    projections of it, ``outputs`` is both in one pass."""

    actions: DataFrame
    columns: list[str]
    strategy: str

    @property
    def state(self) -> DataFrame:
        post = [F.col(f"__post_{c}").alias(c) for c in self.columns]
        return self.actions.filter(F.col(ACTION).isin(*STATE_ACTIONS)).select(*post)

    @property
    def changes(self) -> DataFrame:
        """Change feed rows: all state columns plus ``_change_type``."""
        def image(prefix: str, kind: str) -> Column:
            return F.struct(*[F.col(f"{prefix}{c}").alias(c) for c in self.columns],
                            F.lit(kind).alias(CHANGE_TYPE))
        a = F.col(ACTION)
        images = (F.when(a == "insert", F.array(image("__post_", "insert")))
                  .when(a == "update", F.array(image("__pre_", "update_preimage"),
                                               image("__post_", "update_postimage")))
                  .when(a == "delete", F.array(image("__pre_", "delete"))))
        return (self.actions.filter(a.isin("insert", "update", "delete"))
                .select(F.inline(images)))

    @property
    def outputs(self) -> DataFrame:
        """State and feed rows in one frame: the state columns, ``_change_type``
        (NULL for state rows) and ``KIND``."""
        def image(prefix: str, change: str | None) -> Column:
            return F.struct(*[F.col(f"{prefix}{c}").alias(c) for c in self.columns],
                            F.lit(change).cast("string").alias(CHANGE_TYPE),
                            F.lit("state" if change is None else "changes").alias(KIND))
        a, now = F.col(ACTION), image("__post_", None)
        images = (F.when(a.isin("keep", "unchanged"), F.array(now))
                  .when(a == "insert", F.array(now, image("__post_", "insert")))
                  .when(a == "update", F.array(now, image("__pre_", "update_preimage"),
                                               image("__post_", "update_postimage")))
                  .when(a == "delete", F.array(image("__pre_", "delete"))))
        return self.actions.filter(a != "ignore").select(F.inline(images))

    def action_counts(self) -> DataFrame:
        return self.actions.groupBy(ACTION).agg(F.count(F.lit(1)).alias("rows"))


def choose_strategy(rows: int, size_bytes: int, max_rows: int, max_bytes: int) -> str:
    """``broadcast`` only for a change set whose staged size is known to be
    under both limits; ``shuffle`` otherwise."""
    return "broadcast" if rows <= max_rows and size_bytes <= max_bytes else "shuffle"


def _conjunction(conds):
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def _outer_join(t: DataFrame, s: DataFrame, tk: list[str], sk: list[str], strategy: str,
                empty_t: list[Column], empty_s: list[Column], null_keys: bool) -> DataFrame:
    """Full outer join of target and source on the key, NULL keys matching.

    Rows whose key has no NULL are joined with plain equality, so a target
    stored bucketed by the key is read bucket by bucket and only the source is
    exchanged.  Rows with a NULL in the key (at most one group per side after
    the latest-version step; found through parquet null statistics) are joined
    separately with null-safe equality, or kept where the source has none.
    """
    no_null = lambda cols: _conjunction([F.col(c).isNotNull() for c in cols])
    eq = _conjunction([F.col(a) == F.col(b) for a, b in zip(tk, sk)])
    nse = _conjunction([F.col(a).eqNullSafe(F.col(b)) for a, b in zip(tk, sk)])
    parts = [(t.filter(no_null(tk)), s.filter(no_null(sk)), eq),
             (t.filter(~no_null(tk)), s.filter(~no_null(sk)), nse)]
    out = None
    for tp, sp, cond in parts:
        if cond is nse and not null_keys:
            j = tp.select(*tp.columns, *empty_s)
        elif strategy == "shuffle":
            j = tp.join(sp, cond, "full_outer")
        else:
            matched_side = tp.join(F.broadcast(sp), cond, "left_outer")
            matched_keys = tp.select(*tk).join(F.broadcast(sp.select(*sk)), cond, "left_semi")
            s_only = sp.join(F.broadcast(matched_keys), cond, "left_anti")
            j = matched_side.unionByName(s_only.select(*empty_t, *sp.columns))
        out = j if out is None else out.unionByName(j)
    return out


_INTEGRAL = ("tinyint", "smallint", "int", "bigint")


def can_hold(stored: DataType, new: DataType) -> bool:
    """Whether every value of type ``new`` fits a stored column of type ``stored``."""
    old, src = stored.simpleString(), new.simpleString()
    if old == src or src == "void" or old == "string" and not isinstance(new, (ArrayType, MapType, StructType)):
        return True
    if src in _INTEGRAL and old in _INTEGRAL:
        return _INTEGRAL.index(src) <= _INTEGRAL.index(old)
    if isinstance(stored, DecimalType):
        if isinstance(new, DecimalType):
            return stored.scale >= new.scale and stored.precision - stored.scale >= new.precision - new.scale
        return src in _INTEGRAL and stored.precision - stored.scale >= (3, 5, 10, 19)[_INTEGRAL.index(src)]
    return (src, old) in (("float", "double"), ("int", "double"), ("smallint", "float"), ("smallint", "double"),
                          ("tinyint", "float"), ("tinyint", "double"), ("date", "timestamp"), ("date", "timestamp_ntz"))


def evolve(target: DataFrame, source: DataFrame, extra: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """Additive schema evolution: add source columns missing from the target
    (case-insensitive) as typed NULLs.  Nothing is dropped or widened."""
    add = {}
    for f in source.schema.fields:
        if find_column(target, f.name) is None:
            add[f.name] = F.lit(None).cast(f.dataType)
    for name, ddl_type in extra:
        if find_column(target, name) is None and name not in add:
            add[name] = F.lit(None).cast(ddl_type)
    return target.withColumns(add) if add else target


def merge(target: DataFrame, source: DataFrame, keys: Sequence[str],
          delete_flag: str | None = DELETE_FLAG,
          excluded: Sequence[str] = (),
          ignored: Sequence[str] = IGNORED_COMPARE_COLUMNS,
          preserve: Sequence[str] = (CREATED_STAMP,),
          strategy: str = "shuffle",
          stamp: bool = False, load_time=None, null_keys: bool = True) -> MergeResult:
    """Plan the merge of ``source`` (one row per key) into ``target``.

    ``strategy`` is ``shuffle`` or ``broadcast``; choose ``broadcast`` only
    for a source whose size has been checked (``choose_strategy``).  A source type
    that a stored column cannot hold without loss is an error before any row is read.
    ``stamp`` adds ``_sysCreatedDateTime`` (set on insert, preserved
    afterwards) and ``_sysProcessedDateTime`` (set on every written row);
    ``load_time`` (a datetime) makes the stamp a literal, so separate passes
    over the merge, and recomputed partitions, stamp identically; give it a
    zone, as a datetime without one is the driver's local time.
    ``null_keys``: False if the source is known to have no NULL in its keys.
    """
    if strategy not in ("shuffle", "broadcast"):
        raise ValueError(f"unknown merge strategy {strategy!r}")
    stamps = [(CREATED_STAMP, "timestamp"), (PROCESSED_STAMP, "timestamp")] if stamp else []
    tgt = evolve(target, source, stamps)
    columns = tgt.columns
    types = {c: tgt.schema[c].dataType for c in columns}
    src_of = {c: find_column(source, c) for c in columns}          # target col -> source col
    key_cols = [find_column(tgt, k) for k in keys]
    if None in key_cols or any(src_of[k] is None for k in key_cols):
        raise ValueError(f"merge keys {keys} must exist on both sides")
    flag = find_column(source, delete_flag) if delete_flag else None
    unfit = [f"{c}: {source.schema[src_of[c]].dataType.simpleString()} into {types[c].simpleString()}"
             for c in columns if src_of[c] is not None and not can_hold(types[c], source.schema[src_of[c]].dataType)]
    if unfit:
        raise ValueError("the stored columns cannot hold the new types (reload the table): " + "; ".join(unfit))

    t = tgt.select(*[F.col(c).alias(_T + c) for c in columns], F.lit(True).alias(_TP))
    s = source.select(*[F.col(c).alias(_S + c) for c in source.columns], F.lit(True).alias(_SP))
    tk = [_T + k for k in key_cols]
    sk = [_S + src_of[k] for k in key_cols]

    compared = compare_columns(source.columns, columns, keys, excluded, ignored)
    pairs = [(F.col(_S + c).cast(types[find_column(tgt, c)]), F.col(_T + find_column(tgt, c))) for c in compared]
    deleting = is_delete(F.col(_S + flag)) if flag else F.lit(False)
    t_in, s_in = F.col(_TP).isNotNull(), F.col(_SP).isNotNull()
    action = (F.when(~s_in, "keep")
              .when(deleting, F.when(t_in, "delete").otherwise("ignore"))
              .when(~t_in, "insert")
              .when(rows_differ(pairs), "update")
              .otherwise("unchanged"))

    empty_t = [F.lit(None).cast(types[c]).alias(_T + c) for c in columns] + [F.lit(None).cast("boolean").alias(_TP)]
    empty_s = [F.lit(None).cast(f.dataType).alias(f.name) for f in s.schema.fields]
    joined = _outer_join(t, s, tk, sk, strategy, empty_t, empty_s, null_keys)

    now = F.lit(load_time) if load_time is not None else F.current_timestamp()
    created, processed = find_column(columns, CREATED_STAMP), find_column(columns, PROCESSED_STAMP)
    keep_on_update = {c.lower() for c in [*keys, *preserve]}
    post, pre = [], []
    a = F.col("__a")
    for c in columns:
        tc = F.col(_T + c)
        if stamp and c in (created, processed):
            sc = now.cast(types[c])                    # stamped on insert
            upd = tc if c == created else sc           # created kept, processed renewed
        elif src_of[c] is not None:
            sc = F.col(_S + src_of[c]).cast(types[c])
            upd = tc if c.lower() in keep_on_update else sc
        else:                                          # target-only column (B7)
            sc = F.lit(None).cast(types[c])
            upd = tc
        post.append(F.when(a == "insert", sc).when(a == "update", upd).otherwise(tc).alias(f"__post_{c}"))
        pre.append(tc.alias(f"__pre_{c}"))
    actions = (joined.withColumn("__a", action)
               .select(*post, *pre, F.col("__a").alias(ACTION)))
    return MergeResult(actions=actions, columns=columns, strategy=strategy)
