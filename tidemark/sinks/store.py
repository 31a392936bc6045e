"""Bronze store: parquet snapshots plus a load log (operators A7, A13, B1, B2, B9).

Layout below ``root`` (a shared folder on a cluster)::

    <table>/<run_id>/                  snapshot of a full load
    <table>/<run_id>/_kind=state/      snapshot of a merge
    <table>/<run_id>/_kind=changes/    change feed rows of that merge
    _log/table=<table>/                one parquet row per load

A merge that touches few buckets writes only these; its snapshot then has layers: the new folder's buckets
and, for all others, the folders of earlier loads.

    _bad/table=<table>/_run_id=<run>/  records of a load that didn't fit the model

A load writes a *new* snapshot folder first and appends its log row last, so
readers see either the old snapshot with the old high-water mark or the new
snapshot with the new mark, never a mix.  Each table appends only below its
own ``_log/table=<name>`` folder, so loads of different tables can run at
the same time.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import json
import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.merge import KIND

LOG_DDL = ("snapshot STRING, changes STRING, lastload STRING, "
           "_sysProcessDateTime TIMESTAMP, run_id STRING, mode STRING, rows BIGINT, "
           "buckets INT, bucket_key STRING, seq BIGINT, schema STRING, batch STRING, layers STRING, text_bytes BIGINT")
BAD_DDL = "_folder STRING, _bad_record STRING, _run_id STRING"
_UNKNOWN = object()


def new_run_id() -> str:
    now = _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%dT%H%M%S%fZ")
    return f"{now}-{uuid.uuid4().hex[:8]}"


@dataclass
class Snapshot:
    table: str
    path: str
    lastload: str | None
    run_id: str
    buckets: int | None = None
    bucket_key: str | None = None
    rows: int | None = None
    seq: int = 0
    schema: str | None = None  # of its rows, as JSON
    layers: str | None = None  # folders and the buckets that each holds, newest first, as JSON; None: one folder
    text_bytes: int | None = None  # of its rows' texts, uncompressed


class TableStore:
    """Current-state tables as snapshots named by a load log."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # -- paths --------------------------------------------------------------
    def _log_dir(self, table: str) -> str:
        return f"{self.root}/_log/table={table}"

    def _read_log(self, path: str, ddl: str) -> DataFrame | None:
        """Log rows below ``path``; None only where there is no log yet, other errors propagate."""
        try:
            return self.spark.read.schema(ddl).parquet(path)
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def log(self) -> DataFrame:
        """All load-log rows (``table`` comes from the folder name)."""
        found = self._read_log(f"{self.root}/_log", LOG_DDL + ", table STRING")
        return found if found is not None else self.spark.createDataFrame([], LOG_DDL + ", table STRING")

    @staticmethod
    def _latest() -> Column:
        """The log row of the last commit: commits are numbered, clocks are not trusted."""
        return F.max_by(F.struct("snapshot", "lastload", "run_id", "buckets", "bucket_key", "rows", "seq", "schema", "layers",
                                 "text_bytes"),
                        F.struct(F.coalesce("seq", F.lit(0)), "run_id")).alias("r")

    @staticmethod
    def _snapshot(table: str, r: Row) -> Snapshot:
        return Snapshot(table, r["snapshot"], r["lastload"], r["run_id"], r["buckets"], r["bucket_key"], r["rows"],
                        r["seq"] or 0, r["schema"], r["layers"], r["text_bytes"])

    def current(self, table: str) -> Snapshot | None:
        """Latest committed snapshot of ``table`` (A7/A13); None if never loaded."""
        log = self._read_log(self._log_dir(table), LOG_DDL)
        # One table's loads, a row each: no shuffle for them.
        r = log.coalesce(1).agg(self._latest()).select("r.*").head() if log is not None else None
        return self._snapshot(table, r) if r is not None and r["snapshot"] is not None else None

    def current_all(self, tables=None) -> dict[str, Snapshot]:
        """Latest committed snapshot of every table (or of ``tables``) from one
        read of the whole load log: one job however many tables there are."""
        log = self.log()
        if tables is not None:
            log = log.filter(F.col("table").isin(*list(tables)))
        rows = log.groupBy("table").agg(self._latest()).select("table", "r.*").collect()
        return {r["table"]: self._snapshot(r["table"], r) for r in rows if r["snapshot"]}

    def exists(self, table: str) -> bool:
        return self.current(table) is not None

    def watermark(self, table: str) -> str | None:
        snap = self.current(table)
        return snap.lastload if snap else None

    def has_batch(self, table: str, batch: str) -> bool:
        """Whether a load of this streamed batch was committed."""
        log = self._read_log(self._log_dir(table), LOG_DDL)
        return log is not None and not log.filter(F.col("batch") == batch).isEmpty()

    def read(self, table: str, snapshot: Snapshot | None = None) -> DataFrame:
        """Current state of ``table``.  A bucketed snapshot is read through a
        catalog table declaring its bucketing, so joins and aggregations on
        the key use the stored layout instead of shuffling it."""
        snap = snapshot or self.current(table)
        if snap is None:
            raise ValueError(f"table {table!r} has no snapshot in {self.root}")
        schema = StructType.fromJson(json.loads(snap.schema)) if snap.schema else None
        if snap.layers:
            return self.read_buckets(snap, None)
        if not snap.buckets:
            reader = self.spark.read.schema(schema) if schema is not None else self.spark.read
            return self.state_columns(reader.parquet(snap.path))
        # A name belongs to one snapshot folder for good, so no session or store can be shown another.
        name = (f"tidemark_{re.sub(r'[^0-9A-Za-z_]', '_', table)}_"
                f"{hashlib.sha1(snap.path.encode()).hexdigest()[:16]}")
        if not self.spark.catalog.tableExists(name):
            schema = schema if schema is not None else self.spark.read.parquet(snap.path).schema
            cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            keys = ", ".join(f"`{k}`" for k in snap.bucket_key.split(","))
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet CLUSTERED BY ({keys}) "
                           f"SORTED BY ({keys}) INTO {int(snap.buckets)} BUCKETS LOCATION '{snap.path}'")
        return self.state_columns(self.spark.table(name))

    def read_buckets(self, snap: Snapshot, buckets: set[int] | None) -> DataFrame:
        """Rows of the given buckets of a bucketed snapshot (None: all), read from these buckets' files alone."""
        schema = StructType.fromJson(json.loads(snap.schema))
        files = [f for f, _ in self.bucket_files(snap, buckets)]
        return self.spark.read.schema(schema).parquet(*files) if files else self.spark.createDataFrame([], schema)

    def bucket_files(self, snap: Snapshot, buckets: set[int] | None = None) -> list[tuple[str, int]]:
        """Paths and sizes of the files that hold a bucketed snapshot's rows: of each bucket the newest layer's."""
        found, covered = [], set()
        for layer in json.loads(snap.layers) if snap.layers else [{"path": snap.path, "buckets": None}]:
            own = None if layer["buckets"] is None else set(layer["buckets"])
            for path, size in self._files(layer["path"]):
                bucket = int(re.search(r"_(\d+)(?:\..*)?$", path).group(1))  # Spark's file names end in the bucket's number
                if bucket not in covered and (buckets is None or bucket in buckets) and (own is None or bucket in own):
                    found.append((path, size))
            covered |= own or set()
        return found

    def _files(self, folder: str) -> list[tuple[str, int]]:
        """Data files of a folder; none where it was never made (a write without rows)."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(folder)
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        found = [(st.getPath().toString(), st.getLen()) for st in fs.listStatus(path)] if fs.exists(path) else []
        return [(p, n) for p, n in found if p.endswith(".parquet")]

    @staticmethod
    def state_columns(df: DataFrame) -> DataFrame:
        """Without the feed's columns, which a merge's snapshot files hold as well."""
        return df.drop("_change_type", "_run_id", KIND)

    def changes(self, table: str) -> DataFrame:
        """Change feed of every load (``_run_id`` names the load).

        A full load's feed is its snapshot read as inserts (nothing is copied);
        a merge's feed was written beside its snapshot.  However many loads
        there are, the plan has one scan of each kind; columns added later
        are NULL in earlier feeds."""
        log = self._read_log(self._log_dir(table), LOG_DDL)
        loads = log.select("snapshot", "changes", "mode", "run_id").collect() if log is not None else []
        feeds = [r["changes"] for r in loads if r["changes"]]
        full = {r["snapshot"]: r["run_id"] for r in loads if not r["changes"] and r["mode"] == "replace"}
        merged = self.spark.read.option("mergeSchema", "true")
        frames = [merged.parquet(*feeds)] if feeds else []
        if full:
            folder = F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)(?:/_kind=state)?/[^/]+$", 1)
            frames.append(merged.parquet(*full).withColumn("_change_type", F.lit("insert"))
                          .withColumn("_run_id", folder))
        if not frames:
            raise ValueError(f"table {table!r} has no loads in {self.root}")
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f, allowMissingColumns=True)
        return out

    def net_changes(self, table: str, keys: Sequence[str], after: int = 0, upto: int | None = None) -> DataFrame:
        """What the loads after commit ``after``, up to ``upto``, have changed in all: at most one change per key.

        A fold of the feeds: insert and update are an insert, insert and delete nothing, delete and insert an update, and
        of several updates the first preimage and the last postimage count.  Applied to the state of commit
        ``after`` it gives that of ``upto``.  Rows with a NULL key are one key, as in a merge.  A reload
        in between has no feed to fold, so it is an error.
        """
        log = self._read_log(self._log_dir(table), LOG_DDL)
        if log is None:
            raise ValueError(f"table {table!r} has no loads in {self.root}")
        loads = log.filter((F.col("seq") > after) & (F.lit(upto is None) | (F.col("seq") <= upto)))
        loads = loads.select("run_id", "seq", "mode").collect()
        if any(r["mode"] != "merge" and r["seq"] > 1 for r in loads):
            raise ValueError(f"table {table!r} was reloaded after commit {after}: compare its snapshots instead")
        feed, order = self.changes(table), self.spark.createDataFrame([(r["run_id"], r["seq"]) for r in loads],
                                                                      "_run_id STRING, _seq BIGINT")
        columns = [c for c in feed.columns if c not in ("_change_type", "_run_id")]
        at = F.struct("_seq", F.col("_change_type") != "update_preimage")  # of an update the preimage comes first
        row = F.struct(*columns, "_change_type")
        ends = (feed.join(F.broadcast(order), "_run_id").groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys])
                .agg(F.min_by(row, at).alias("first"), F.max_by(row, at).alias("last")))
        was, stays = F.col("first._change_type") != "insert", F.col("last._change_type") != "delete"

        def image(end: str, kind: str) -> Column:
            return F.struct(*[F.col(f"{end}.{c}").alias(c) for c in columns], F.lit(kind).alias("_change_type"))

        net = (F.when(was & stays, F.array(image("first", "update_preimage"), image("last", "update_postimage")))
               .when(stays, F.array(image("last", "insert"))).when(was, F.array(image("first", "delete"))))
        return ends.filter(was | stays).select(F.inline(net))

    def bad_records(self, table: str) -> DataFrame:
        """Records of all committed loads that didn't fit the model: ``_folder``, ``_bad_record``, ``_run_id``."""
        found, log = self._read_log(f"{self.root}/_bad/table={table}", BAD_DDL), self._read_log(self._log_dir(table), LOG_DDL)
        if found is None or log is None:
            return self.spark.createDataFrame([], BAD_DDL)
        return found.join(log.select(F.col("run_id").alias("_run_id")), "_run_id", "left_semi")

    # -- writes -------------------------------------------------------------
    def write_bad(self, table: str, records: DataFrame, run_id: str) -> None:
        records.write.mode("error").parquet(f"{self.root}/_bad/table={table}/_run_id={run_id}")

    def write_snapshot(self, table: str, df: DataFrame, run_id: str,
                       bucket_key: str | None = None, buckets: int | None = None) -> str:
        """Write a new snapshot folder; bucketed by ``bucket_key`` (one column,
        or several joined by commas) when given.

        A bucketed write keeps each task's rows per bucket; rows already hash
        partitioned by the key into ``buckets`` partitions give one file per
        bucket.  The catalog entry used for writing is dropped right after
        (the table is external: only its metadata goes)."""
        path = f"{self.root}/{table}/{run_id}"
        if bucket_key and buckets:
            name = f"tidemark_w_{uuid.uuid4().hex[:16]}"
            keys = bucket_key.split(",")
            (df.write.format("parquet").bucketBy(int(buckets), keys[0], *keys[1:]).sortBy(keys[0], *keys[1:])
             .option("path", path).saveAsTable(name))
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        else:
            df.write.mode("error").parquet(path)
        return path

    def write_merge(self, table: str, df: DataFrame, run_id: str,
                    bucket_key: str | None = None, buckets: int | None = None) -> tuple[str, str]:
        """Write state and change feed of one merge (``MergeResult.outputs``) in one
        pass; returns the folders of the snapshot and of the feed."""
        path = f"{self.root}/{table}/{run_id}"
        writer = df.withColumn("_run_id", F.lit(run_id)).write.partitionBy(KIND)
        if bucket_key and buckets:
            name = f"tidemark_w_{uuid.uuid4().hex[:16]}"
            keys = bucket_key.split(",")
            (writer.format("parquet").bucketBy(int(buckets), keys[0], *keys[1:]).sortBy(keys[0], *keys[1:])
             .option("path", path).saveAsTable(name))
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        else:
            writer.mode("error").parquet(path)
        return f"{path}/{KIND}=state", f"{path}/{KIND}=changes"

    def commit(self, table: str, snapshot: str, lastload: str | None, run_id: str,
               mode: str, rows: int | None, changes: str | None = None,
               buckets: int | None = None, bucket_key: str | None = None, after=_UNKNOWN,
               schema: StructType | None = None, batch: str | None = None, layers: str | None = None,
               text_bytes: int | None = None) -> None:
        """Append the log row that makes ``snapshot`` current.

        Commits of a table are numbered; ``after`` is the snapshot this load
        started from (None for the first), read from the log if not given.
        ``schema`` is that of the snapshot's rows; readers then needn't look for it in files.
        ``batch`` names the streamed batch that was loaded; ``layers`` is there where a load wrote some buckets only.
        ``text_bytes`` are those of the rows' texts; the next load sizes its buckets by them.
        """
        before = self.current(table) if after is _UNKNOWN else after
        seq = (before.seq if before is not None else 0) + 1
        now = _dt.datetime.now(_dt.timezone.utc)
        row = [(snapshot, changes, lastload, now, run_id, mode, rows, buckets, bucket_key, seq,
                schema.json() if schema is not None else None, batch, layers, text_bytes)]
        (self.spark.createDataFrame(row, LOG_DDL).coalesce(1)
         .write.mode("append").parquet(self._log_dir(table)))

    def replace(self, table: str, df: DataFrame, lastload: str | None = None,
                mode: str = "replace") -> Snapshot:
        """Full replace (B1/B2): write a new snapshot and make it current."""
        run_id, before, seen = new_run_id(), self.current(table), Observation()
        path = self.write_snapshot(table, df.observe(seen, F.count(F.lit(1)).alias("rows")), run_id)
        rows = seen.get["rows"]
        self.commit(table, path, lastload, run_id, mode, rows, after=before, schema=df.schema)
        return Snapshot(table, path, lastload, run_id, rows=rows, seq=(before.seq if before else 0) + 1,
                        schema=df.schema.json())
