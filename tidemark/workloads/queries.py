"""Registered queries: one per operator group, each over whole given tables.

Every function takes ``(spark, sf_dir)`` and returns a lazy DataFrame whose
column names equal those of the matching oracle SQL (``oracle.py``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from tidemark.config import BAD_RECORD, LandingConfig
from tidemark.functions.enums import decode_enums, enum_case_text
from tidemark.functions.keys import guid_from_ids, record_id_from_guid, repair_keys, table_id_from_guid
from tidemark.functions.predicates import is_delete
from tidemark.functions.timestamps import parse_sink_timestamp
from tidemark.operators.latest import latest_change, latest_version
from tidemark.operators.merge import ACTION, choose_strategy, merge
from tidemark.operators.silver import (invoice_header_profile, invoice_line_profile,
                                       silver_customer as _silver_customer,
                                       silver_sales_invoice as _silver_sales_invoice, violations)
from tidemark.sources.csvscan import csv_field, csv_files, read_entity_csv, write_entity_csv, write_lines
from tidemark.sources.landing import (changelog_folders, files_from_paths, plan_loads,
                                      table_folders, folder_is_open)
from tidemark.sources.model import schema_catalog as _schema_catalog
from tidemark.operators.silver import build_view, customer_rows
from tidemark.plans.ingest import apply_changes
from tidemark.session import scratch_path, stage_measured
from tidemark.sinks.store import TableStore
from tidemark.sources.tables import read_config, select_tables
from tidemark.workloads import derive as d

EXCLUDED = ("versionnumber",)


def _changes(spark, sf_dir, null_key=None) -> DataFrame:
    return d.lineitem_changes(d.table(spark, sf_dir, "lineitem"), null_key)


def _initial(changes: DataFrame) -> DataFrame:
    """Latest change per record, deletes removed, meta dropped."""
    latest = latest_change(changes, d.CHANGE_KEY, d.CHANGE_ORDER)
    return latest.filter(~is_delete(F.col("IsDelete"))).drop(*EXCLUDED)


def _source(changes: DataFrame) -> DataFrame:
    return latest_change(changes, d.CHANGE_KEY, d.CHANGE_ORDER).drop(*EXCLUDED)


def _merge(spark, sf_dir, strategy="shuffle", null_key=None):
    ch = _changes(spark, sf_dir, null_key)
    return merge(_initial(d.first_batch(ch)), _source(d.second_batch(ch)), d.CHANGE_KEY,
                 strategy=strategy)


# --- G1 -------------------------------------------------------------------
def latest_event_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = d.table(spark, sf_dir, "events")
    return latest_version(ev, ["user_id"], ["ts", "event_id"], tiebreak=False)


def latest_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = d.table(spark, sf_dir, "lineitem")
    return latest_version(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"], tiebreak=True)


# --- B1 / B3-B8 -------------------------------------------------------------
def initial_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _initial(_changes(spark, sf_dir))


def merge_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merge(spark, sf_dir, "shuffle").state


def merge_state_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The size-checked merge into a table that isn't stored bucketed: the
    change set is staged in the shared folder, measured, and broadcast only
    under the limits (larger change sets fall back to the shuffle join)."""
    ch = _changes(spark, sf_dir)
    source, _, seen, size = stage_measured(_source(d.second_batch(ch)), "merge-source")
    strategy = choose_strategy(seen["rows"], size, max_rows=100_000, max_bytes=4 << 20)
    return merge(_initial(d.first_batch(ch)), source, d.CHANGE_KEY, strategy=strategy).state


def merge_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merge(spark, sf_dir, "shuffle").action_counts()


def change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merge(spark, sf_dir, "shuffle").changes


def merge_added_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    ch = _changes(spark, sf_dir)
    target = (_initial(d.first_batch(ch)).drop("l_tax")
              .withColumn("l_shipyear", F.year("SinkModifiedOn")))
    return merge(target, _source(d.second_batch(ch)), d.CHANGE_KEY).state


def merge_null_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merge(spark, sf_dir, "shuffle", null_key=F.col("l_discount") == 0).state


def changed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    def split(df):
        return df.select("recid", "IsDelete",
                         F.when(F.col("l_linestatus") == "F", F.col("l_quantity")).alias("qty_f"),
                         F.when(F.col("l_linestatus") == "O", F.col("l_quantity")).alias("qty_o"))
    ch = _changes(spark, sf_dir)
    res = merge(split(_initial(d.first_batch(ch))), split(_source(d.second_batch(ch))), d.CHANGE_KEY)
    return (res.actions.filter(F.col(ACTION).isin("update", "unchanged"))
            .select(F.col("__post_recid").alias("recid"), F.col(ACTION)))


# --- through the store --------------------------------------------------------
STAMPS = ("_sysCreatedDateTime", "_sysProcessedDateTime")


def _stored(spark, *loads: DataFrame) -> tuple[TableStore, list[dt.datetime]]:
    """A store with table ``lineitem`` after a full load and merges; the times before, between and after them."""
    cfg = LandingConfig(landing_root="", store_root=scratch_path(spark, "store"), key=d.CHANGE_KEY,
                        version_order=d.CHANGE_ORDER, excluded_meta=EXCLUDED)
    store, times = TableStore(spark, cfg.store_root), [dt.datetime.now(dt.timezone.utc)]
    for k, changes in enumerate(loads, 1):
        apply_changes(spark, cfg, store, "lineitem", _source(changes), f"f{k}", f"f{k}")
        times.append(dt.datetime.now(dt.timezone.utc))
    return store, times


def merge_stored_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A merge into a stored, bucketed snapshot, read back."""
    ch = _changes(spark, sf_dir)
    return _stored(spark, d.first_batch(ch), d.second_batch(ch))[0].read("lineitem").drop(*STAMPS)


def stored_change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B8 through the store: the feed of both loads."""
    ch = _changes(spark, sf_dir)
    return _stored(spark, d.first_batch(ch), d.second_batch(ch))[0].changes("lineitem").drop(*STAMPS, "_run_id")


def net_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B8 over a range: what the second and the third load changed in all, a change per record."""
    ch = _changes(spark, sf_dir)
    store, _ = _stored(spark, d.first_batch(ch), d.second_batch(ch), d.third_batch(ch))
    return store.net_changes("lineitem", d.CHANGE_KEY, after=1).drop(*STAMPS)


def stored_added_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B6/B7 through the store: a column that only the stored table has, one that only the changes have."""
    ch = _changes(spark, sf_dir)
    first = d.first_batch(ch).drop("l_tax").withColumn("l_shipyear", F.year("SinkModifiedOn"))
    return _stored(spark, first, d.second_batch(ch))[0].read("lineitem").drop(*STAMPS)


def load_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per stored row whether its stamps are in order and within the run, and what they say happened to it."""
    ch = _changes(spark, sf_dir)
    store, times = _stored(spark, d.first_batch(ch), d.second_batch(ch))
    begun, between, ended = map(F.lit, times)
    created, processed = (F.col(c) for c in STAMPS)
    return store.read("lineitem").select(
        "recid", (created <= processed).alias("created_first"),
        (created.between(begun, ended) & processed.between(begun, ended)).alias("within_run"),
        F.when(created < processed, "update").when(created > between, "insert").otherwise("keep").alias("written"))


# --- J7 / F1 ----------------------------------------------------------------
def enum_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    enums = d.nation_enums(d.table(spark, sf_dir, "nation"))
    cust = d.table(spark, sf_dir, "customer").withColumns(
        {"c_state": F.pmod("c_custkey", F.lit(12)), "c_tier": F.pmod("c_custkey", F.lit(25)).cast("int")})
    return decode_enums(cust, enums, "customer")


def enum_case_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enum_case_text(d.nation_enums(d.table(spark, sf_dir, "nation")))


# --- J1-J4, J8 --------------------------------------------------------------
def record_id_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = d.table(spark, sf_dir, "orders")
    g = o.select("o_orderkey", guid_from_ids(F.col("o_custkey"), F.col("o_orderkey")).alias("sl_id"),
                 guid_from_ids(F.col("o_custkey"), -F.col("o_orderkey") - 1).alias("g2"))
    return g.select("o_orderkey", "sl_id", record_id_from_guid(F.col("sl_id")).alias("recid"),
                    table_id_from_guid(F.col("sl_id")).alias("tableid"),
                    record_id_from_guid(F.col("g2")).alias("recid_topbit"))


def table_id_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = d.table(spark, sf_dir, "orders")
    rows = o.select(
        "o_orderkey",
        guid_from_ids(F.col("o_custkey"), F.col("o_orderkey")).alias("sl_id"),
        F.when(F.col("o_orderstatus") != "O", F.col("o_custkey") + 1000000).alias("tableid"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).alias("recid"))
    return repair_keys(rows).select("o_orderkey", "tableid", "recid")


def sink_timestamp_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = d.table(spark, sf_dir, "orders")
    text = F.concat(F.date_format("o_orderdate", "M/d/yyyy h:mm:ss a"),
                    F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(" junk")).otherwise(F.lit("")))
    return o.select("o_orderkey", parse_sink_timestamp(text).cast("timestamp_ntz").alias("SinkModifiedOn"))


# --- A4-A11 -----------------------------------------------------------------
def _changelog_text(ev: DataFrame) -> DataFrame:
    day = F.expr("INTERVAL 1 DAY")
    return ev.select(F.concat_ws(",", d.folder_of(F.col("ts") - day), d.folder_of(F.col("ts"))).alias("value"))


def changelog_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = d.table(spark, sf_dir, "events")
    return changelog_folders(_changelog_text(ev)).agg(F.max("folder_name").alias("latest_folder"))


LANDING_BASE = "/landing"


def _listing(ev: DataFrame) -> DataFrame:
    """A landing listing derived from ``events``: one file per (day folder,
    event type as table, user); the extension cycles through .csv, .CSV and
    .json, so some table folders hold no CSV file."""
    ext = F.element_at(F.array(F.lit(".csv"), F.lit(".CSV"), F.lit(".json")),
                       (F.pmod("event_id", F.lit(3)) + 1).cast("int"))
    path = F.concat(F.lit(LANDING_BASE + "/"), d.folder_of(F.col("ts")), F.lit("/"), F.col("event_type"),
                    F.lit("/part-"), F.col("user_id").cast("string"), ext)
    return files_from_paths(ev.select(path.alias("path")).distinct(), LANDING_BASE)


def _latest_folder(ev: DataFrame) -> str:
    """The folder the changelog names as open (a scalar, as the job reads it)."""
    return changelog_folders(_changelog_text(ev)).agg(F.max("folder_name")).head()[0]


def closed_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = d.table(spark, sf_dir, "events")
    pairs = table_folders(_listing(ev))
    return pairs.filter(folder_is_open(F.col("folder"), d.FIRST_MARK, _latest_folder(ev)))


def _marks(ev: DataFrame) -> DataFrame:
    """A load log derived from ``events``: each table's high-water mark is the
    folder of its first event plus as many days as its name has letters."""
    first = ev.groupBy("event_type").agg(F.min("ts").alias("t0"))
    return first.select(F.col("event_type").alias("tableName"),
                        d.folder_of(F.expr("t0 + make_interval(0, 0, 0, length(event_type))")).alias("lastload"))


def _plan(ev: DataFrame) -> DataFrame:
    return plan_loads(_listing(ev), _marks(ev), _latest_folder(ev))


def incremental_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = d.table(spark, sf_dir, "events")
    pairs = _plan(ev).select(F.col("table").alias("event_type"), "folder").distinct()
    return (ev.withColumn("folder", d.folder_of(F.col("ts")))
            .join(pairs, ["event_type", "folder"], "inner")
            .select("event_id", "ts", "user_id", "event_type", "value", "folder"))


def next_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = d.table(spark, sf_dir, "events")
    return _plan(ev).groupBy(F.col("table").alias("tableName")).agg(F.max("folder").alias("lastload"))


def table_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, n = d.table(spark, sf_dir, "supplier"), d.table(spark, sf_dir, "nation")
    config = s.join(n, s.s_nationkey == n.n_nationkey).select(
        F.lower("s_name").alias("table_name"), F.concat(F.lit("pg_"), F.lower("n_name")).alias("processing_group"))
    return select_tables(config, "pg_nation_7", "supplier#000000001, supplier#000000002")


def config_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The config table read from where it is stored, then selected by group."""
    s, n = d.table(spark, sf_dir, "supplier"), d.table(spark, sf_dir, "nation")
    path = scratch_path(spark, "config")
    (s.join(n, s.s_nationkey == n.n_nationkey)
     .select(F.lower("s_name").alias("table_name"), F.concat(F.lit("pg_"), F.lower("n_name")).alias("processing_group"))
     .write.parquet(path))
    return select_tables(read_config(spark, path, "parquet"), "pg_nation_3", None)


# --- A3 / C1-C4 -------------------------------------------------------------
def schema_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _schema_catalog(d.model_attributes_from_lineitem(d.table(spark, sf_dir, "lineitem")))


# --- Silver -----------------------------------------------------------------
def _customer_parts(spark, sf_dir, party_name):
    c, n = d.table(spark, sf_dir, "customer"), d.table(spark, sf_dir, "nation")
    cust = c.select(F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("accountnum"),
                    F.col("c_nationkey").alias("custgroup"), F.col("c_mktsegment").alias("dlvterm"),
                    F.col("c_custkey").alias("party"), F.lit(d.COMPANY).alias("dataareaid"))
    group = n.select(F.col("n_nationkey").alias("custgroup"), F.lit(d.COMPANY).alias("dataareaid"),
                     F.col("n_name").alias("name"))
    party = c.select(F.col("c_custkey").alias("recid"), party_name.alias("name"))
    return cust, group, party


def silver_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver_customer(*_customer_parts(spark, sf_dir, F.col("c_name")))


def silver_customer_unmatched_party(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parties that no customer refers to may have blank names."""
    cust, group, party = _customer_parts(spark, sf_dir, F.col("c_name"))
    blank = party.select((-F.col("recid") - 1).alias("recid"), F.lit(None).cast("string").alias("name"))
    return _silver_customer(cust, group, party.unionByName(blank))


def silver_view_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view is stored once; building it again leaves it as it is."""
    store = TableStore(spark, scratch_path(spark, "silver"))
    view = _silver_customer(*_customer_parts(spark, sf_dir, F.col("c_name")))
    build_view(store, "silver_customer", view)
    build_view(store, "silver_customer", view.filter("party % 2 = 0"))
    return store.read("silver_customer")


def name_check_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _customer_parts(spark, sf_dir, F.when(F.col("c_acctbal") >= 0, F.col("c_name")))
    return violations(_silver_customer(*parts, check=False), F.col("customername") != F.lit(""))


def _invoices(spark, sf_dir, dealt=False):
    return d.invoice_tables(d.table(spark, sf_dir, "lineitem"), d.table(spark, sf_dir, "orders"), dealt)


def silver_sales_invoice(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust, group, party = _customer_parts(spark, sf_dir, F.col("c_name"))
    customers = customer_rows(cust.withColumn("accountnum", F.col("party").cast("string")), group, party)
    return _silver_sales_invoice(*_invoices(spark, sf_dir, dealt=True), customers)


def invoice_header_profile_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return invoice_header_profile(_invoices(spark, sf_dir)[0])


def invoice_line_profile_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return invoice_line_profile(_invoices(spark, sf_dir)[1])


# --- A1 round trip ----------------------------------------------------------
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, half of them with CRLF line breaks inside their texts, exported and read back."""
    docs = d.table(spark, sf_dir, "documents")
    docs = docs.withColumn("text", F.when(F.col("doc_id") % 2 == 1, F.regexp_replace("text", "\n", "\r\n"))
                           .otherwise(F.col("text")))
    path = scratch_path(spark, "csv-round-trip")
    write_entity_csv(docs, path)          # one file per scan split
    return read_entity_csv(spark, f"{path}/*.csv", docs.schema, with_folder=False)


def csv_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same texts read back with every file cut into sixteen ranges or more, at any line break of a text."""
    docs = d.table(spark, sf_dir, "documents")
    docs = docs.withColumn("text", F.when(F.col("doc_id") % 2 == 1, F.regexp_replace("text", "\n", "\r\n"))
                           .otherwise(F.col("text")))
    path = f"{scratch_path(spark, 'csv-ranges')}/folder/documents"
    write_entity_csv(docs, path)
    longest = csv_files(spark, [path]).agg(F.max("length")).head()[0] or 0
    return read_entity_csv(spark, path, docs.schema, with_folder=False, range_bytes=max(4096, longest // 16))


def csv_bad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders exported with short, long and untypable records among them: what is read, and what is said to be bad."""
    o = d.table(spark, sf_dir, "orders")
    fields = [csv_field(F.col("o_orderkey"), LongType()), csv_field(F.col("o_custkey"), LongType()),
              csv_field(F.col("o_orderdate"), o.schema["o_orderdate"].dataType), csv_field(F.col("o_orderpriority"), StringType())]
    kind = F.col("o_orderkey") % 32
    line = (F.when(kind == 1, F.concat_ws(",", *fields[:2])).when(kind == 2, F.concat_ws(",", *fields, F.lit('"more"')))
            .when(kind == 3, F.concat_ws(",", fields[0], F.lit('"x1"'), *fields[2:]))
            .when(kind == 4, F.concat_ws(",", *fields[:2], F.lit('"some day"'), fields[3])).otherwise(F.concat_ws(",", *fields)))
    path = scratch_path(spark, "csv-bad")
    write_lines(o.select(line.alias("value")), path)
    schema = StructType([StructField("o_orderkey", LongType()), StructField("o_custkey", LongType()),
                         StructField("o_orderdate", TimestampType()), StructField("o_orderpriority", StringType())])
    rows = read_entity_csv(spark, path, schema, with_folder=False, bad_column=BAD_RECORD)
    return rows.select("o_orderkey", "o_custkey", F.col("o_orderdate").isNull().alias("no_date"), "o_orderpriority",
                       F.col(BAD_RECORD).alias("bad_record"))


# --- M1-M6 end to end -------------------------------------------------------
def ingest_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.workloads.flagship import two_run_load
    return two_run_load(spark, d.table(spark, sf_dir, "orders"))


def reload_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2: a reload after the first load reads every closed folder afresh."""
    from tidemark.workloads.flagship import reload_load
    return reload_load(spark, d.table(spark, sf_dir, "orders"))


def stream_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """2.K: the same two loads by the stream of closed folders; the open folder isn't loaded."""
    from tidemark.workloads.flagship import stream_load
    return stream_load(spark, d.table(spark, sf_dir, "orders"))


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3/M5: run logs of two runs over three tables, one without folders (A11) and one that fails."""
    from tidemark.workloads.flagship import two_run_logs
    return two_run_logs(spark, d.table(spark, sf_dir, "orders"))


QUERIES = {
    "latest_event_per_user": latest_event_per_user,
    "latest_lineitem": latest_lineitem,
    "initial_load": initial_load,
    "merge_state": merge_state,
    "merge_state_broadcast": merge_state_broadcast,
    "merge_actions": merge_actions,
    "change_feed": change_feed,
    "merge_added_column": merge_added_column,
    "merge_null_key": merge_null_key,
    "changed_rows": changed_rows,
    "enum_decode": enum_decode,
    "enum_case_list": enum_case_list,
    "record_id_decode": record_id_decode,
    "table_id_decode": table_id_decode,
    "sink_timestamp_parse": sink_timestamp_parse,
    "changelog_latest": changelog_latest,
    "closed_folders": closed_folders,
    "incremental_slice": incremental_slice,
    "next_watermark": next_watermark,
    "table_selection": table_selection,
    "schema_catalog": schema_catalog,
    "silver_customer": silver_customer,
    "silver_sales_invoice": silver_sales_invoice,
    "invoice_header_profile": invoice_header_profile_q,
    "invoice_line_profile": invoice_line_profile_q,
    "name_check_violations": name_check_violations,
    "csv_round_trip": csv_round_trip,
    "csv_ranges": csv_ranges,
    "csv_bad_rows": csv_bad_rows,
    "ingest_two_runs": ingest_two_runs,
    "config_scan": config_scan,
    "load_stamps": load_stamps,
    "merge_stored_table": merge_stored_table,
    "reload_state": reload_state,
    "run_log": run_log,
    "stream_state": stream_state,
    "silver_customer_unmatched_party": silver_customer_unmatched_party,
    "silver_view_build": silver_view_build,
    "stored_added_column": stored_added_column,
    "stored_change_feed": stored_change_feed,
    "net_changes": net_changes,
}

__all__ = ["QUERIES", "LandingConfig"]
