"""End-to-end scenario: export ``orders`` as a landing tree, load it twice.

Folders (string-ordered):

* ``F1`` every order, version 1 (record id NULL for finished orders, so it is
  repaired from the GUID; priority exported as an integer enum code);
* ``F2`` changes: open orders re-priced (high-priority ones twice, the later
  version wins), pending orders deleted, urgent finished orders re-sent as new
  records, low-priority finished orders deleted under unknown keys (ignored),
  medium finished orders re-sent unchanged;
* ``F3`` the folder still being written (named by the changelog on the
  second run): deletes everything, and must not be loaded.

Run 1 sees changelog ``F2`` and loads ``F1``; run 2 sees ``F3`` and loads
``F2``.  Enum metadata is loaded from the newest changelog folder first.
"""

from __future__ import annotations

import concurrent.futures as cf

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import LandingConfig
from tidemark.functions.keys import guid_from_ids
from tidemark.plans.ingest import ingest_all, load_enums
from tidemark.session import drop_path, scratch_path
from tidemark.sinks.store import TableStore
from tidemark.streaming import stream_table
from tidemark.sources.export import write_changelog, write_enums, write_folder, write_model

# Fixed parameters of the scenario.
TABLE = "orders"
TABLE_ID = 119
F1, F2, F3 = "2024-01-01T00.00.00Z", "2024-01-02T00.00.00Z", "2024-01-03T00.00.00Z"
SINK_TIME = {F1: "1/1/2024 12:00:00 AM", F2: "1/2/2024 1:30:00 PM", F3: "1/3/2024 12:00:00 AM"}
NEW_KEY_OFFSET = 1_000_000_000
UNKNOWN_KEY_OFFSET = 2_000_000_000
ORDERS_MODEL = (
    ("Id", "guid"), ("SinkCreatedOn", "datetime"), ("SinkModifiedOn", "datetime"),
    ("IsDelete", "boolean"), ("recid", "int64"), ("tableid", "int64"), ("versionnumber", "int64"),
    ("recversion", "int64"), ("createdtransactionid", "int64"), ("modifiedtransactionid", "int64"),
    ("o_custkey", "int64"), ("o_orderstatus", "string"), ("o_totalprice", "decimal"),
    ("o_orderdate", "datetime"), ("o_orderpriority", "int32"), ("dataareaid", "string"),
)
LOGGED = ("table", "status", "source_rows", "inserted", "updated", "deleted", "unchanged", "ignored", "rows_after")
OUTPUT = ("recid", "SinkCreatedOn", "SinkModifiedOn", "IsDelete", "recversion", "o_custkey",
          "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority", "dataareaid")


def _col(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def export_rows(o: DataFrame, folder: str, key: Column, version, recversion,
                price: Column, delete: Column, repair_recid: bool = False) -> DataFrame:
    """Orders rows in model column order, as the exporter writes them."""
    version, recversion = _col(version), _col(recversion)
    return o.select(
        guid_from_ids(F.lit(TABLE_ID).cast("bigint"), key).alias("Id"),
        F.lit(SINK_TIME[F1]).alias("SinkCreatedOn"),
        F.lit(SINK_TIME[folder]).alias("SinkModifiedOn"),
        delete.alias("IsDelete"),
        (F.when(F.col("o_orderstatus") != "F", key) if repair_recid else key).alias("recid"),
        F.lit(None).cast("bigint").alias("tableid"),
        version.cast("bigint").alias("versionnumber"),
        recversion.cast("bigint").alias("recversion"),
        F.lit(0).cast("bigint").alias("createdtransactionid"),
        F.lit(0).cast("bigint").alias("modifiedtransactionid"),
        "o_custkey", "o_orderstatus", price.alias("o_totalprice"), "o_orderdate",
        F.substring("o_orderpriority", 1, 1).cast("int").alias("o_orderpriority"),
        F.lit("dat").alias("dataareaid"))


def build_landing(spark: SparkSession, orders: DataFrame, root: str, files: int | None = None) -> None:
    """Write the three folders; ``files``: files per folder (default: one per
    scan split, so file sizes follow the input split size at any scale)."""
    o = orders
    k = F.col("o_orderkey")
    price = F.col("o_totalprice").cast("decimal(15,2)")
    st, pr = F.col("o_orderstatus"), F.col("o_orderpriority")
    live = F.when(pr == "4-NOT SPECIFIED", F.lit(None).cast("boolean")).otherwise(F.lit(False))
    f1 = export_rows(o, F1, k, 1, 1, price, live, repair_recid=True)
    # Folder F2 in one scan: each order yields zero, one or two change rows.
    def change(cond, key, version, recversion, new_price, delete):
        return F.when(cond, F.struct(key.alias("k"), F.lit(version).alias("v"), F.lit(recversion).alias("rv"),
                                     new_price.alias("p"), delete.cast("boolean").alias("d")))
    variants = F.array(
        change(st == "O", k, 2, 2, price + 1, live),
        change((st == "O") & (pr == "2-HIGH"), k, 3, 3, price + 2, live),
        change(st == "P", k, 2, 2, price, F.lit(True)),
        change((st == "F") & (pr == "1-URGENT"), k + NEW_KEY_OFFSET, 1, 1, price, F.lit(False)),
        change((st == "F") & (pr == "5-LOW"), k + UNKNOWN_KEY_OFFSET, 2, 2, price, F.lit(True)),
        change((st == "F") & (pr == "3-MEDIUM"), k, 2, 1, price, live))
    c = o.select("*", F.explode(F.filter(variants, lambda x: x.isNotNull())).alias("c"))
    f2 = export_rows(c, F2, F.col("c.k"), F.col("c.v"), F.col("c.rv"), F.col("c.p"), F.col("c.d"))
    f3 = export_rows(o, F3, k, 9, 9, price, F.lit(True))
    enums = (o.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("o_orderpriority").alias("OptionSetName"),
        F.substring("o_orderpriority", 1, 1).cast("bigint").alias("Option"),
        F.lit(False).alias("IsUserLocalizedLabel"), F.lit(1033).cast("bigint").alias("LocalizedLabelLanguageCode"),
        F.col("o_orderpriority").alias("LocalizedLabel"), F.lit("priority").alias("GlobalOptionSetName"),
        F.lit(TABLE).alias("EntityName"), F.col("o_orderpriority").alias("OptionName")))
    # independent outputs: submitted as concurrent Spark jobs
    writes = [lambda: write_model(spark, root, {TABLE: ORDERS_MODEL}),
              lambda: write_folder(f1, root, F1, TABLE, files),
              lambda: write_folder(f2, root, F2, TABLE, files),
              lambda: write_folder(f3, root, F3, TABLE, files),
              lambda: write_enums(enums, root, F2),
              lambda: write_enums(enums, root, F3)]
    with cf.ThreadPoolExecutor(max_workers=len(writes)) as pool:
        for fut in [pool.submit(w) for w in writes]:
            fut.result()


def _set_up(spark: SparkSession, orders: DataFrame) -> tuple[LandingConfig, TableStore]:
    root = scratch_path(spark, "landing")
    cfg = LandingConfig(landing_root=root, store_root=scratch_path(spark, "bronze"))
    build_landing(spark, orders, root)
    return cfg, TableStore(spark, cfg.store_root)


def _run(spark: SparkSession, cfg: LandingConfig, store: TableStore, changelog: str, tables=(TABLE,),
         reload: bool = False) -> list:
    """One run of the master job; returns its run log."""
    config = spark.createDataFrame([(t, "pg_daily") for t in tables], "table_name STRING, processing_group STRING")
    write_changelog(spark, cfg.landing_root, changelog)
    load_enums(spark, cfg, store)
    return ingest_all(spark, cfg, config, processing_group="pg_daily", reload=reload).collect()


def _state(spark: SparkSession, cfg: LandingConfig, store: TableStore, log: list) -> DataFrame:
    bad = [r for r in log if r["status"] == "failed"]
    if bad:
        raise RuntimeError(f"load failed: {bad[0]['error']}")
    drop_path(spark, cfg.landing_root)  # loaded: only the stored table is read from here on
    # Sink times are zone-less text (session wall clock); the order date was
    # exported with 'Z' (UTC), so its UTC wall clock is taken explicitly.
    tz = spark.conf.get("spark.sql.session.timeZone")
    casts = {c: F.col(c).cast("timestamp_ntz") for c in ("SinkCreatedOn", "SinkModifiedOn")}
    casts["o_orderdate"] = F.to_utc_timestamp(F.col("o_orderdate"), tz).cast("timestamp_ntz")
    return store.read(TABLE).withColumns(casts).select(*OUTPUT)


def two_run_load(spark: SparkSession, orders: DataFrame) -> DataFrame:
    """Build the landing tree, run two incremental loads, return the state."""
    cfg, store = _set_up(spark, orders)
    log = [r for changelog in (F2, F3) for r in _run(spark, cfg, store, changelog)]
    return _state(spark, cfg, store, log)


def stream_load(spark: SparkSession, orders: DataFrame) -> DataFrame:
    """The two incremental loads as two runs of the folder stream; returns the state."""
    cfg, store = _set_up(spark, orders)
    for changelog in (F2, F3):
        write_changelog(spark, cfg.landing_root, changelog)
        load_enums(spark, cfg, store)
        stream_table(spark, cfg, TABLE, store=store).awaitTermination()
    return _state(spark, cfg, store, [])


def reload_load(spark: SparkSession, orders: DataFrame) -> DataFrame:
    """A first load, then a reload of all closed folders; returns the state."""
    cfg, store = _set_up(spark, orders)
    log = _run(spark, cfg, store, F2) + _run(spark, cfg, store, F3, reload=True)
    return _state(spark, cfg, store, log)


def two_run_logs(spark: SparkSession, orders: DataFrame) -> DataFrame:
    """Run logs of two runs over ``orders``, a table without folders and one that is not in the model."""
    cfg, store = _set_up(spark, orders)
    for folder in (F1, F2):
        write_folder(orders.select("o_orderkey"), cfg.landing_root, folder, "unmodelled")
    logs = [(run, *[r[f] for f in LOGGED]) for run, changelog in ((1, F2), (2, F3))
            for r in _run(spark, cfg, store, changelog, (TABLE, "absent", "unmodelled"))]
    return spark.createDataFrame(logs, "run INT, table STRING, status STRING, source_rows BIGINT, inserted BIGINT, "
                                       "updated BIGINT, deleted BIGINT, unchanged BIGINT, ignored BIGINT, rows_after BIGINT")
