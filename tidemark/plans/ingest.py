"""Ingestion jobs (operators M1-M6).

``ingest_table``  M1/M2  landing CSV -> current-state bronze table
``ingest_all``    M3/M4/M5  every selected table of a config table, with a run log
``load_enums``    M6  enum metadata file -> ``_enum_translations``

One table load is a single lazy plan from the CSV scan to the latest row per
key; that change set is staged once in the shared checkpoint folder (cuts
lineage, gives an exact size), then joined once with the stored table.  The
new snapshot and the change feed are written by one pass over that join, and
made current together with the high-water mark by one log row.
"""

from __future__ import annotations

import concurrent.futures as cf
import datetime as _dt
import functools
import json
import operator
import threading
import traceback
from collections.abc import Iterable

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructType

from tidemark.config import (BAD_RECORD, CREATED_STAMP, ENUM_FILE, ENUM_TABLE, PROCESSED_STAMP,
                             LandingConfig)
from tidemark.functions.columns import find_column
from tidemark.functions.enums import decode_enums
from tidemark.functions.keys import repair_keys
from tidemark.functions.predicates import is_delete
from tidemark.functions.timestamps import parse_sink_columns
from tidemark.operators.latest import latest_change
from tidemark.operators.merge import ACTION, ACTIONS, STATE_ACTIONS, merge
from tidemark.session import drop_path, path_size_bytes, stage_measured
from tidemark.sinks.store import Snapshot, TableStore, new_run_id
from tidemark.sources.csvscan import FOLDER_COLUMN, read_enum_csv, read_entity_csv
from tidemark.sources.landing import changelog_head, changelog_latest, loadable_folders
from tidemark.sources.model import (entity_schemas_and_unknown, model_attributes, read_model,
                                    schema_catalog)
from tidemark.sources.tables import select_tables

RUN_LOG_DDL = ("table STRING, status STRING, strategy STRING, folder_from STRING, folder_to STRING, "
               "folders BIGINT, source_rows BIGINT, inserted BIGINT, updated BIGINT, deleted BIGINT, "
               "unchanged BIGINT, ignored BIGINT, rows_after BIGINT, run_id STRING, error STRING, warning STRING, "
               "bad_rows BIGINT")
RUN_LOG_FIELDS = [f.split(" ")[0] for f in RUN_LOG_DDL.split(", ")]
_UNSET = object()


def _run_row(table: str, status: str, **kw) -> dict:
    row = dict.fromkeys(RUN_LOG_FIELDS)
    row.update(table=table, status=status, **kw)
    return row


def plan_tables(spark: SparkSession, cfg: LandingConfig, store: TableStore,
                tables: Iterable[str], reload: bool = False,
                snapshots: dict | None = None) -> dict[str, list[str]]:
    """Folders to load per table, in order: ``{table: [folder, ...]}``.

    ``snapshots``: current snapshots per table if already read (one job for
    all tables otherwise).
    """
    tables = list(tables)
    latest = changelog_head(spark, cfg.changelog_path)
    snaps = {} if reload else (snapshots if snapshots is not None else store.current_all(tables))
    marks = {t: (snaps[t].lastload if t in snaps else None) for t in tables}
    return loadable_folders(spark, cfg.landing_root, marks, latest)


def read_changes(spark: SparkSession, cfg: LandingConfig, table: str, folders: list[str],
                 enums: DataFrame | None, schema=None) -> DataFrame:
    """Scan one table's CSV files of the given landing folders, then
    ``prepare_changes``.  ``schema``: the table's model schema if known."""
    schema = schema if schema is not None else table_schema(spark, cfg, table)
    return prepare_changes(scan_folders(spark, cfg, table, folders, schema).drop(BAD_RECORD), cfg, table, enums)


def scan_folders(spark: SparkSession, cfg: LandingConfig, table: str, folders: list[str], schema) -> DataFrame:
    """One table's rows of the given landing folders, with ``BAD_RECORD``."""
    root = cfg.landing_root.rstrip("/")
    return read_entity_csv(spark, [f"{root}/{f}/{table}" for f in folders], schema,
                           range_bytes=cfg.csv_range_bytes, bad_column=BAD_RECORD)


def table_schemas(spark: SparkSession, cfg: LandingConfig, tables: list[str]) -> tuple[dict, dict[str, str]]:
    """Model schema of each table (an exception where it has none), and a warning
    for each table with attribute types the model doesn't define (read as string)."""
    # The model is one JSON document, so its attributes are in one partition anyway.
    catalog = schema_catalog(model_attributes(read_model(spark, cfg.model_path)).coalesce(1))
    schemas, unknown = entity_schemas_and_unknown(catalog, tables)
    return schemas, {t: "unknown types read as string: " + ", ".join(v) for t, v in unknown.items()}


def table_schema(spark: SparkSession, cfg: LandingConfig, table: str):
    schema = table_schemas(spark, cfg, [table])[0][table]
    if isinstance(schema, Exception):
        raise schema
    return schema


def prepare_changes(rows: DataFrame, cfg: LandingConfig, table: str, enums: DataFrame | None) -> DataFrame:
    """Key repair -> sink timestamps -> enum decode -> latest per key -> drop
    meta columns.  Delete markers take part in the ranking and are kept (the
    merge needs them)."""
    rows = repair_keys(rows)
    rows = parse_sink_columns(rows)
    if enums is not None:
        rows = decode_enums(rows, enums, table, cfg.inline_enum_codes)
    latest = latest_change(rows, cfg.key, cfg.version_order, extra_order=[FOLDER_COLUMN])
    return latest.drop(FOLDER_COLUMN, *cfg.excluded_meta)


def _text_bytes(schema: StructType, prefix: str = "", where: Column | None = None) -> Column:
    """Sum of the bytes of all texts, which a row holds beside its columns' eight bytes each (of the rows ``where``)."""
    sizes = [F.coalesce(F.octet_length(F.col(f"`{prefix}{f.name}`")), F.lit(0)).cast("long") for f in schema.fields
             if isinstance(f.dataType, (StringType, BinaryType))]
    size = functools.reduce(operator.add, sizes, F.lit(0).cast("long"))
    return F.coalesce(F.sum(size if where is None else F.when(where, size)), F.lit(0).cast("long"))


def _in_memory(rows: int, schema: StructType, text_bytes: int) -> int:
    """Bytes that tasks hold for so many rows, about."""
    return rows * 8 * (len(schema.fields) + 2) + text_bytes


def _bucketing(cfg: LandingConfig, source: DataFrame, stored_bytes: int,
               held_bytes: int) -> tuple[str | None, int | None]:
    """Bucket columns (the record key, comma-joined) and count for ``stored_bytes``, of which tasks hold ``held_bytes``."""
    keys = [find_column(source, k) for k in cfg.key]
    if not cfg.bucketed or None in keys:
        return None, None
    key = ",".join(keys)
    if cfg.buckets:
        return key, cfg.buckets
    need = max(1, -(-stored_bytes // cfg.bucket_bytes), -(-held_bytes // cfg.bucket_memory))
    n = 8
    while n < need and n < cfg.max_buckets:
        n *= 2
    return key, n


def _by_key(df: DataFrame, key: str, buckets: int) -> DataFrame:
    return df.repartition(buckets, *[F.col(k) for k in key.split(",")])


def ingest_table(spark: SparkSession, cfg: LandingConfig, table: str, reload: bool = False,
                 store: TableStore | None = None, folders: list[str] | None = None,
                 current=_UNSET, enums=_UNSET, schema=None, warning: str | None = None,
                 batch: str | None = None, stopped: threading.Event | None = None) -> dict:
    """M1/M2: load one table; returns its run-log row (a dict).

    ``reload`` ignores the high-water mark, reads every closed folder and
    replaces the table.  With no folder to load the table and its mark are
    left alone (status ``skipped``).  A load that decodes enums fails where the
    enum metadata was never loaded.
    """
    store = store or TableStore(spark, cfg.store_root)
    if folders is None:
        folders = plan_tables(spark, cfg, store, [table], reload)[table]
    if not folders:
        return _run_row(table, "skipped")
    if enums is _UNSET:
        enums = enum_table(store) if cfg.decode_enums else None
    if cfg.decode_enums and enums is None:
        raise ValueError(f"{ENUM_TABLE} has not been loaded; load the enum metadata first, or load without enums")
    if schema is None:
        schemas, warnings = table_schemas(spark, cfg, [table])
        schema, warning = schemas[table], warnings.get(table)
    if isinstance(schema, Exception):
        raise schema
    scanned, seen = scan_folders(spark, cfg, table, folders, schema), Observation()
    rows = scanned.observe(seen, F.count(BAD_RECORD).alias("bad_rows")).drop(BAD_RECORD)
    changes = prepare_changes(rows, cfg, table, enums)
    row = apply_changes(spark, cfg, store, table, changes, folders[0], folders[-1], len(folders), reload, current,
                        before_commit=lambda run_id: quarantine(store, table, scanned, run_id, seen.get["bad_rows"]),
                        batch=batch, stopped=stopped)
    return row | {"warning": warning, "bad_rows": seen.get["bad_rows"]}


def quarantine(store: TableStore, table: str, scanned: DataFrame, run_id: str, bad_rows: int) -> None:
    """Store the records of a load that don't fit the model.  Only a load that has some reads its files again."""
    if bad_rows:
        store.write_bad(table, scanned.where(F.col(BAD_RECORD).isNotNull()).select(FOLDER_COLUMN, BAD_RECORD), run_id)


def enum_table(store: TableStore) -> DataFrame | None:
    snap = store.current(ENUM_TABLE)
    return store.read(ENUM_TABLE, snap) if snap else None


def apply_changes(spark: SparkSession, cfg: LandingConfig, store: TableStore, table: str,
                  changes: DataFrame, folder_from: str | None, folder_to: str | None,
                  folders: int | None = None, reload: bool = False, current=_UNSET, before_commit=None,
                  batch: str | None = None, stopped: threading.Event | None = None) -> dict:
    """Stage the latest change per key, then replace (first load / reload) or
    merge into the stored table, and commit snapshot + high-water mark.
    ``current``: the table's current snapshot if already read; ``before_commit`` is called
    with the run id once the changes have been read.  ``batch``: the streamed batch that this load is."""
    before = store.current(table) if current is _UNSET else current
    keys = [find_column(changes, k) for k in cfg.key]
    no_key = functools.reduce(operator.or_, [F.col(k).isNull() for k in keys if k is not None], F.lit(False))
    source, staged_path, seen, staged_bytes = stage_measured(changes, f"{table}-changes", null_keys=F.count_if(no_key),
                                                              text_bytes=_text_bytes(changes.schema))
    try:
        load, run_id = _replace if before is None or reload else _merge, new_run_id()
        if before_commit is not None:
            before_commit(run_id)
        return load(spark, cfg, _Guarded(store, stopped), table, before, source, seen, staged_bytes, batch,
                    dict(folder_from=folder_from, folder_to=folder_to, folders=folders, source_rows=seen["rows"],
                         run_id=run_id))
    finally:
        drop_path(spark, staged_path)


class _Guarded(TableStore):
    """The store of a load that may be stopped: it doesn't commit after that."""

    def __init__(self, store: TableStore, stopped: threading.Event | None):
        super().__init__(store.spark, store.root)
        self.stopped = stopped

    def commit(self, *args, **kw) -> None:
        if self.stopped is not None and self.stopped.is_set():
            raise RuntimeError("the load was stopped before its commit")
        super().commit(*args, **kw)


def _replace(spark: SparkSession, cfg: LandingConfig, store: TableStore, table: str, before: Snapshot | None,
             source: DataFrame, staged: dict, staged_bytes: int, batch: str | None, common: dict) -> dict:
    flag = find_column(source, cfg.delete_flag)
    state = source.filter(~is_delete(F.col(flag))) if flag else source
    if cfg.stamp_rows:
        now = F.lit(_dt.datetime.now(_dt.timezone.utc))
        state = state.withColumns({CREATED_STAMP: now, PROCESSED_STAMP: now})
    seen = Observation()
    texts = _text_bytes(state.schema)
    state = state.observe(seen, F.count(F.lit(1)).alias("rows"), texts.alias("text_bytes"))
    key, buckets = _bucketing(cfg, source, staged_bytes, _in_memory(staged["rows"], state.schema, staged["text_bytes"]))
    if buckets:
        state = _by_key(state, key, buckets)
    run_id = common["run_id"]
    snapshot = store.write_snapshot(table, state, run_id, key, buckets)
    rows = seen.get["rows"]
    store.commit(table, snapshot, common["folder_to"], run_id, "replace", rows, None, buckets, key, after=before,
                 schema=state.schema, batch=batch, text_bytes=seen.get["text_bytes"])
    return _run_row(table, "loaded", strategy="replace", inserted=rows, rows_after=rows, **common)


def _bucket_of(key: str, buckets: int, types: dict) -> Column:
    """The bucket that Spark's bucketed writer gives a row, by its key columns in their stored types."""
    return F.pmod(F.hash(*[F.col(k).cast(types[k]) for k in key.split(",")]), F.lit(buckets))


def _touched_buckets(cfg: LandingConfig, before: Snapshot, source: DataFrame, rows: int) -> set[int] | None:
    """Buckets of the stored table that the changes fall into; None where rewriting all of it is as good."""
    layers = len(json.loads(before.layers)) if before.layers else 1
    # With more rows than buckets hardly a bucket is left out.
    if not before.buckets or not before.schema or before.rows is None or rows > before.buckets or layers >= cfg.max_layers:
        return None
    stored = StructType.fromJson(json.loads(before.schema))
    if any(find_column(source, k) != k for k in before.bucket_key.split(",")):
        return None
    types = {k: stored[k].dataType for k in before.bucket_key.split(",")}
    bucket = _bucket_of(before.bucket_key, before.buckets, types)
    found = {r[0] for r in source.select(bucket.alias("b")).distinct().collect()}  # no more than buckets
    return found if len(found) <= cfg.touched_share * before.buckets else None


def _merge(spark: SparkSession, cfg: LandingConfig, store: TableStore, table: str, before: Snapshot,
           source: DataFrame, staged: dict, staged_bytes: int, batch: str | None, common: dict) -> dict:
    """The staged source carries no partitioning, so against a bucketed target
    only the source is exchanged (into the target's bucket count).  State and feed
    are one pass over one join, and the counts are observed by that pass.

    Where the changes fall into few buckets, only these are read, joined and written; the new
    snapshot takes the others from where they are."""
    key, buckets = before.bucket_key, before.buckets
    stored_bytes = sum(n for _, n in store.bucket_files(before)) if before.layers else path_size_bytes(spark, before.path)
    stored = StructType.fromJson(json.loads(before.schema)) if before.schema else source.schema
    held = (_in_memory(before.rows or 0, stored, before.text_bytes or 0)
            + _in_memory(staged["rows"], source.schema, staged["text_bytes"]))
    want_key, want = _bucketing(cfg, source, stored_bytes + staged_bytes, held)
    moves = bool(want) and (key != want_key or not max(want, 1) / 2 < (buckets or 0) < 2 * want)
    touched = None if moves else _touched_buckets(cfg, before, source, staged["rows"])
    target = store.read(table, before) if touched is None else store.state_columns(store.read_buckets(before, touched))
    result = merge(target, source, cfg.key, cfg.delete_flag, cfg.excluded_meta,
                   cfg.ignored_compare, stamp=cfg.stamp_rows, load_time=_dt.datetime.now(_dt.timezone.utc),
                   null_keys=staged["null_keys"] > 0)
    seen = Observation()
    state = result.state.schema
    result.actions = result.actions.observe(
        seen, *[F.count_if(F.col(ACTION) == a).alias(a) for a in ACTIONS],
        _text_bytes(state, "__pre_").alias("texts_before"),
        _text_bytes(state, "__post_", F.col(ACTION).isin(*STATE_ACTIONS)).alias("texts_after"))
    outputs = result.outputs
    if touched is not None:
        types = {k: outputs.schema[k].dataType for k in key.split(",")}
        outputs = outputs.repartition(max(1, len(touched)), _bucket_of(key, buckets, types))
    elif moves or before.layers:
        key, buckets = want_key, want
        outputs = _by_key(outputs, key, buckets) if buckets else outputs
    run_id = common["run_id"]
    snapshot, feed = store.write_merge(table, outputs, run_id, key, buckets)
    n = {a: seen.get[a] for a in ACTIONS}
    rows = n["keep"] + n["unchanged"] + n["update"] + n["insert"]
    layers, texts = None, seen.get["texts_after"]
    if touched is not None:
        rows = before.rows + n["insert"] - n["delete"]
        texts += (before.text_bytes or 0) - min(seen.get["texts_before"], before.text_bytes or 0)
        older = json.loads(before.layers) if before.layers else [{"path": before.path, "buckets": None}]
        layers = json.dumps([{"path": snapshot, "buckets": sorted(touched)}, *older]) if rows else None
    # A late file of an older folder never moves the mark back.
    mark = max((m for m in (common["folder_to"], before.lastload) if m is not None), default=None)
    snapshot = snapshot if rows else _empty_state(store, table, outputs, run_id)
    changed = n["insert"] + n["update"] + n["delete"] > 0
    store.commit(table, snapshot, mark, run_id, "merge", rows, feed if changed else None,
                 buckets if rows else None, key if rows else None, after=before,
                 schema=TableStore.state_columns(outputs).schema, batch=batch, layers=layers, text_bytes=texts)
    return _run_row(table, "merged", strategy="shuffle" if touched is None else "touched", inserted=n["insert"],
                    updated=n["update"], deleted=n["delete"], unchanged=n["unchanged"], ignored=n["ignore"],
                    rows_after=rows, **common)


def _empty_state(store: TableStore, table: str, outputs: DataFrame, run_id: str) -> str:
    """A snapshot folder for a table that lost its last row (a partitioned write of no rows makes none)."""
    return store.write_snapshot(table, TableStore.state_columns(outputs).limit(0), f"{run_id}-empty")


def ingest_all(spark: SparkSession, cfg: LandingConfig, config: DataFrame,
               processing_group: str | None = None, table_names=None, reload: bool = False,
               parallelism: int = 4) -> DataFrame:
    """M3/M4/M5: load every selected table; a failure is recorded, not raised.

    Tables are independent: with ``parallelism`` > 1 they are loaded from that many driver threads at once.  A
    table's jobs carry a tag of its own, and run in a scheduler pool of its name (which counts where
    ``spark.scheduler.mode`` is FAIR).  A table that takes longer than ``cfg.table_seconds`` has its jobs
    cancelled by the tag, is recorded as failed and commits nothing; the others go on.
    """
    store = TableStore(spark, cfg.store_root)
    selected = select_tables(config, processing_group, table_names)
    tables = sorted({r["table_name"] for r in selected.select("table_name").collect()})
    snaps = store.current_all([*tables, ENUM_TABLE]) if tables else {}
    plan = plan_tables(spark, cfg, store, tables, reload, snaps) if tables else {}
    enums = store.read(ENUM_TABLE, snaps[ENUM_TABLE]) if cfg.decode_enums and ENUM_TABLE in snaps else None
    with_files = [t for t in tables if plan.get(t)]
    schemas, warnings = table_schemas(spark, cfg, with_files) if with_files else ({}, {})
    sc, run = spark.sparkContext, new_run_id()

    def one(t: str) -> dict:
        tag, stopped = f"tidemark-{run}-{t}", threading.Event()

        def stop() -> None:
            stopped.set()
            sc.cancelJobsWithTag(tag)

        limit = threading.Timer(cfg.table_seconds, stop) if cfg.table_seconds else None
        sc.addJobTag(tag)
        sc.setLocalProperty("spark.scheduler.pool", t)
        try:
            if limit:
                limit.daemon = True
                limit.start()
            return ingest_table(spark, cfg, t, reload, store, plan.get(t, []), snaps.get(t), enums,
                                schemas.get(t), warnings.get(t), stopped=stopped)
        except Exception as e:  # noqa: BLE001 - the run log carries the failure
            late = f"stopped after {cfg.table_seconds} s: " if stopped.is_set() else ""
            return _run_row(t, "failed", error=f"{late}{type(e).__name__}: {e}\n{traceback.format_exc()}")
        finally:
            if limit:
                limit.cancel()
            sc.removeJobTag(tag)
            sc.setLocalProperty("spark.scheduler.pool", None)

    if parallelism > 1 and len(tables) > 1:
        with cf.ThreadPoolExecutor(max_workers=parallelism) as pool:
            # Each table's thread starts from the caller's properties.
            rows = list(pool.map(lambda t: inheritable_thread_target(spark)(lambda: one(t))(), tables))
    else:
        rows = [one(t) for t in tables]
    return spark.createDataFrame([tuple(r[f] for f in RUN_LOG_FIELDS) for r in rows], RUN_LOG_DDL)


def run_outcome(run_log: DataFrame) -> dict:
    """PASS/FAIL and error count of a run log."""
    failed = run_log.filter(F.col("status") == "failed").count()
    return {"result": "FAIL" if failed else "PASS", "errors": failed}


def load_enums(spark: SparkSession, cfg: LandingConfig, store: TableStore | None = None):
    """M6: read the enum metadata of the newest folder named in the changelog
    and replace ``_enum_translations``.  Returns the snapshot, or None."""
    store = store or TableStore(spark, cfg.store_root)
    latest = changelog_latest(spark, cfg.changelog_path)
    if latest is None:
        return None
    df = read_enum_csv(spark, f"{cfg.landing_root.rstrip('/')}/{latest}/{ENUM_FILE}")
    return store.replace(ENUM_TABLE, df, lastload=latest, mode="enum")
