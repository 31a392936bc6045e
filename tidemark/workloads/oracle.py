"""DuckDB SQL with the same results as the registered queries.

Written independently of the Spark plans (plain SQL over the pre-registered
views), column names equal to the Spark output.  The merge oracle is the
action table of the module doc in ``operators/merge.py`` spelled out as a
full outer join with ``IS NOT DISTINCT FROM`` keys.
"""

from __future__ import annotations

from tidemark.config import SYSTEM_FOLDERS
from tidemark.workloads import derive as d

FMT = "'%Y-%m-%dT%H.%M.%SZ'"
PAYLOAD = list(d.PAYLOAD)
STATE_COLS = ["recid", "SinkModifiedOn", "recversion", "IsDelete", *PAYLOAD]
TIE = ["IsDelete", *PAYLOAD]


def _desc(cols):
    return ", ".join(f"{c} DESC NULLS LAST" for c in cols)


def changes_sql(null_key: str | None = None) -> str:
    recid = "l_orderkey * 10 + l_linenumber"
    if null_key:
        recid = f"CASE WHEN {null_key} THEN NULL ELSE {recid} END"
    return f"""SELECT {recid} AS recid,
  CAST(CASE WHEN l_linestatus <> 'O' THEN year(l_shipdate) END AS BIGINT) AS versionnumber,
  l_shipdate AS SinkModifiedOn, l_suppkey AS recversion,
  CASE WHEN l_returnflag = 'R' THEN true WHEN l_returnflag = 'A' THEN false END AS IsDelete,
  {', '.join(PAYLOAD)}
FROM lineitem"""


RANK = f"row_number() OVER (PARTITION BY recid ORDER BY {_desc(['versionnumber', 'SinkModifiedOn', 'recversion', *TIE])})"
FIRST = f"SinkModifiedOn < TIMESTAMP '{d.CUTOFF}'"
SECOND = f"(SinkModifiedOn >= TIMESTAMP '{d.CUTOFF}' OR recversion % {d.RESENT} = 0)"


def latest_sql(ch: str, where: str = "TRUE", cols=STATE_COLS, live_only=False) -> str:
    live = " AND NOT coalesce(IsDelete, false)" if live_only else ""
    return (f"SELECT {', '.join(cols)} FROM (SELECT *, {RANK} AS rn FROM ({ch}) c WHERE {where}) r "
            f"WHERE rn = 1{live}")


def merge_sql(t_sql: str, s_sql: str, t_cols: list[str], s_cols: list[str], types: dict[str, str],
              compare: list[str], output: str = "state", key: str = "recid", flag: str = "IsDelete") -> str:
    """Merge oracle.  ``output``: state | actions | changes | joined."""
    cols = t_cols + [c for c in s_cols if c not in t_cols]
    t_sel = [f"tt.{c} AS t_{c}" if c in t_cols else f"CAST(NULL AS {types[c]}) AS t_{c}" for c in cols]
    s_sel = [f"ss.{c} AS s_{c}" for c in s_cols]
    differ = " OR ".join(f"s_{c} IS DISTINCT FROM t_{c}" for c in compare) or "false"
    post = []
    for c in cols:
        sc = f"s_{c}" if c in s_cols else f"CAST(NULL AS {types.get(c, 'VARCHAR')})"
        upd = f"t_{c}" if (c == key or c not in s_cols) else f"s_{c}"
        post.append(f"CASE WHEN action = 'insert' THEN {sc} WHEN action = 'update' THEN {upd} ELSE t_{c} END AS {c}")
    joined = f"""j AS (
  SELECT {', '.join(t_sel + s_sel)}, tt.tp, ss.sp
  FROM (SELECT *, 1 AS tp FROM ({t_sql}) x) tt
  FULL OUTER JOIN (SELECT *, 1 AS sp FROM ({s_sql}) y) ss ON tt.{key} IS NOT DISTINCT FROM ss.{key}),
a AS (SELECT *, CASE WHEN sp IS NULL THEN 'keep'
    WHEN coalesce(s_{flag}, false) THEN CASE WHEN tp IS NULL THEN 'ignore' ELSE 'delete' END
    WHEN tp IS NULL THEN 'insert'
    WHEN {differ} THEN 'update' ELSE 'unchanged' END AS action FROM j),
p AS (SELECT {', '.join(post)}, {', '.join(f't_{c}' for c in cols)}, action FROM a)"""
    names = ", ".join(cols)
    pre = ", ".join(f"t_{c} AS {c}" for c in cols)
    if output == "state":
        return f"WITH {joined} SELECT {names} FROM p WHERE action IN ('keep', 'unchanged', 'update', 'insert')"
    if output == "actions":
        return f"WITH {joined} SELECT action AS _action, CAST(count(*) AS BIGINT) AS rows FROM p GROUP BY action"
    if output == "joined":
        return f"WITH {joined} SELECT * FROM p"
    return f"""WITH {joined}
SELECT {names}, 'insert' AS _change_type FROM p WHERE action = 'insert'
UNION ALL SELECT {pre}, 'update_preimage' FROM p WHERE action = 'update'
UNION ALL SELECT {names}, 'update_postimage' FROM p WHERE action = 'update'
UNION ALL SELECT {pre}, 'delete' FROM p WHERE action = 'delete'"""


COMPARE = ["recversion", "IsDelete", *PAYLOAD]


def _std_merge(output: str, null_key: str | None = None) -> str:
    ch = changes_sql(null_key)
    return merge_sql(latest_sql(ch, FIRST, live_only=True), latest_sql(ch, SECOND),
                     STATE_COLS, STATE_COLS, {}, COMPARE, output)


def _net_changes() -> str:
    ch, names = changes_sql(), ", ".join(STATE_COLS)
    again = (f"SELECT * REPLACE (l_quantity + 1 AS l_quantity, recversion % 4 = 1 AS IsDelete) FROM ({ch}) c "
             f"WHERE {SECOND} AND recversion % 4 < 2")
    third = latest_sql(again)
    merged = {o: merge_sql("SELECT * FROM s2", third, STATE_COLS, STATE_COLS, {}, COMPARE, o) for o in ("state", "changes")}
    image = lambda s: ", ".join(f"{s}.{c} AS {c}" for c in STATE_COLS)
    return f"""WITH s1 AS ({latest_sql(ch, FIRST, live_only=True)}), s2 AS ({_std_merge('state')}),
s3 AS ({merged['state']}), touched AS (SELECT recid FROM ({_std_merge('changes')}) x UNION SELECT recid FROM ({merged['changes']}) y)
SELECT {names}, 'insert' AS _change_type FROM s3 WHERE recid NOT IN (SELECT recid FROM s1)
UNION ALL SELECT {names}, 'delete' FROM s1 WHERE recid NOT IN (SELECT recid FROM s3)
UNION ALL SELECT {image('s1')}, 'update_preimage' FROM s1 JOIN s3 USING (recid) JOIN touched USING (recid)
UNION ALL SELECT {image('s3')}, 'update_postimage' FROM s1 JOIN s3 USING (recid) JOIN touched USING (recid)"""


def _added_column() -> str:
    ch = changes_sql()
    t_cols = [c for c in STATE_COLS if c != "l_tax"] + ["l_shipyear"]
    t_sql = (f"SELECT {', '.join(c for c in STATE_COLS if c != 'l_tax')}, "
             f"CAST(year(SinkModifiedOn) AS INTEGER) AS l_shipyear FROM ({latest_sql(ch, FIRST, live_only=True)}) i")
    return merge_sql(t_sql, latest_sql(ch, SECOND), t_cols, STATE_COLS,
                     {"l_tax": "DOUBLE", "l_shipyear": "INTEGER"}, COMPARE, "state")


def _changed_rows() -> str:
    ch = changes_sql()
    split = ("SELECT recid, IsDelete, CASE WHEN l_linestatus = 'F' THEN l_quantity END AS qty_f, "
             "CASE WHEN l_linestatus = 'O' THEN l_quantity END AS qty_o FROM ({}) z")
    cols = ["recid", "IsDelete", "qty_f", "qty_o"]
    joined = merge_sql(split.format(latest_sql(ch, FIRST, live_only=True)), split.format(latest_sql(ch, SECOND)),
                       cols, cols, {}, ["IsDelete", "qty_f", "qty_o"], "joined")
    return f"SELECT recid, action AS _action FROM ({joined}) q WHERE action IN ('update', 'unchanged')"


def _nation_enums() -> str:
    def rows(attr, entity, lang, label, cond):
        return (f"SELECT '{attr}' AS OptionSetName, CAST(n_nationkey AS BIGINT) AS Option, "
                f"false AS IsUserLocalizedLabel, CAST({lang} AS BIGINT) AS LocalizedLabelLanguageCode, "
                f"{label} AS LocalizedLabel, 'nation' AS GlobalOptionSetName, '{entity}' AS EntityName, "
                f"{label} AS OptionName FROM nation WHERE {cond}")
    return " UNION ALL ".join([
        rows("c_nationkey", "customer", 1033, "n_name", "n_regionkey <> 4"),
        rows("c_nationkey", "customer", 1031, "lower(n_name)", "n_regionkey = 0"),
        rows("s_nationkey", "supplier", 1033, "n_name", "true"),
        rows("c_missing", "customer", 1033, "n_name", "n_regionkey = 1"),
        rows("c_state", "customer", 1033, "upper(n_name)", "n_nationkey < 10"),
        rows("c_tier", "customer", 1033, "'it''s ' || n_name", "n_regionkey = 3")])


LOOKUP = ("SELECT EntityName AS entity, OptionSetName AS attribute, Option AS code, min(OptionName) AS label "
          f"FROM ({_nation_enums()}) e WHERE OptionName IS NOT NULL GROUP BY EntityName, OptionSetName, Option")


def _folder(ts: str) -> str:
    return f"strftime(date_trunc('day', {ts}), {FMT})"


EVENTS_FILES = f"""SELECT *, {_folder('ts')} AS folder,
  ['.csv', '.CSV', '.json'][(event_id % 3) + 1] AS ext FROM events"""
LATEST = (f"SELECT max(f) AS l FROM (SELECT unnest(string_split({_folder('ts - INTERVAL 1 DAY')} || ',' || "
          f"{_folder('ts')}, ',')) AS f FROM events) c")
SYSTEM = "(" + ", ".join(f"'{name}'" for name in SYSTEM_FOLDERS) + ")"
PLAN = f"""WITH ev AS ({EVENTS_FILES}),
files AS (SELECT DISTINCT folder, event_type AS tbl, ext, user_id FROM ev),
marks AS (SELECT event_type AS tbl, {_folder('min(ts) + to_days(CAST(length(event_type) AS INTEGER))')} AS lastload
          FROM events GROUP BY event_type),
plan AS (SELECT f.tbl, f.folder FROM files f LEFT JOIN marks m ON f.tbl = m.tbl
         WHERE lower(f.ext) = '.csv' AND (m.lastload IS NULL OR f.folder > m.lastload)
           AND f.folder < ({LATEST}) AND f.folder NOT IN {SYSTEM})"""

NAMES = "[" + ", ".join(f"'{n}'" for n in d.MODEL_NAMES) + "]"
TYPES = "[" + ", ".join(f"'{t}'" for t in d.MODEL_TYPES) + "]"
LOW_ACC = "list_transform(f.acc, lambda x: lower(x))"
PICK = (f"CASE WHEN a.name IS NULL OR NOT list_contains({LOW_ACC}, lower(a.name)) THEN a.name "
        f"ELSE a.name || CAST(list_filter(range(1, len(f.acc) + 2), "
        f"lambda k: NOT list_contains({LOW_ACC}, lower(a.name || CAST(k AS VARCHAR))))[1] AS VARCHAR) END")
TYPE_CASE = """CASE WHEN column_name IN ('SinkCreatedOn', 'SinkModifiedOn') AND lower(data_type) = 'datetime' THEN 'string'
  WHEN lower(data_type) IN ('datetime', 'datetimeoffset') THEN 'timestamp'
  WHEN lower(data_type) = 'date' THEN 'date'
  WHEN lower(data_type) = 'boolean' THEN 'boolean'
  WHEN lower(data_type) IN ('int16', 'int32') THEN 'int'
  WHEN lower(data_type) = 'int64' THEN 'bigint'
  WHEN lower(data_type) = 'float' THEN 'float'
  WHEN lower(data_type) = 'double' THEN 'double'
  WHEN lower(data_type) = 'decimal' THEN 'decimal(38,6)'
  ELSE 'string' END"""
KNOWN = ("('datetime', 'datetimeoffset', 'date', 'boolean', 'int16', 'int32', 'int64', 'float', "
         "'double', 'decimal', 'string', 'guid')")
SCHEMA_CATALOG = f"""WITH RECURSIVE attrs AS (
  SELECT 'order_' || CAST(l_orderkey AS VARCHAR) AS entity,
    CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
         l_quantity, l_extendedprice, l_shipdate) - 1 AS INTEGER) AS ordinal,
    {NAMES}[(l_partkey % {len(d.MODEL_NAMES)}) + 1] AS name,
    {TYPES}[(l_suppkey % {len(d.MODEL_TYPES)}) + 1] AS data_type
  FROM lineitem),
fold(entity, ordinal, acc) AS (
  SELECT DISTINCT entity, -1, CAST([] AS VARCHAR[]) FROM attrs
  UNION ALL
  SELECT f.entity, a.ordinal, list_append(f.acc, (SELECT CASE WHEN p = 'Id' THEN 'sl_id' WHEN p = 'fno_id' THEN 'id' ELSE p END
                                                  FROM (SELECT {PICK} AS p)))
  FROM fold f JOIN attrs a ON a.entity = f.entity AND a.ordinal = f.ordinal + 1),
named AS (
  SELECT a.entity, a.ordinal, a.name AS source_name, f.acc[a.ordinal + 1] AS column_name, a.data_type
  FROM attrs a JOIN fold f ON f.entity = a.entity AND f.ordinal = a.ordinal)
SELECT entity, ordinal, source_name, column_name, data_type, {TYPE_CASE} AS spark_type,
  lower(data_type) IN {KNOWN} AS known_type,
  count(*) OVER (PARTITION BY entity, lower(column_name)) > 1 AS duplicate
FROM named"""


def _customer(party_name: str) -> str:
    return f"""SELECT 'C' || CAST(c.c_custkey AS VARCHAR) AS accountnum, c.c_nationkey AS custgroup,
  c.c_mktsegment AS dlvterm, c.c_custkey AS party, n.n_name AS customergroup,
  coalesce({party_name}, '') AS customername
FROM customer c
JOIN nation n ON n.n_nationkey = c.c_nationkey AND '{d.COMPANY}' = '{d.COMPANY}'
JOIN customer p ON p.c_custkey = c.c_custkey"""


INVOICES = f"""WITH lines AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS invoiceid, CAST(l_shipdate AS DATE) AS invoicedate,
    '{d.COMPANY}' AS dataareaid, 'USD' AS currencycode, CAST(l_orderkey AS VARCHAR) AS salesid,
    l_linenumber AS linenum, CAST(l_partkey AS VARCHAR) AS itemid, l_quantity AS qty,
    CAST(l_extendedprice AS DECIMAL(38,6)) AS lineamount FROM lineitem),
agg AS (
  SELECT l_orderkey, CAST(l_shipdate AS DATE) AS invoicedate,
    sum(CAST(l_extendedprice AS DECIMAL(38,6))) AS invoiceamount,
    sum(CAST(CAST(l_extendedprice AS DECIMAL(15,2)) * CAST(l_tax AS DECIMAL(15,2)) AS DECIMAL(38,6))) AS sumtax
  FROM lineitem GROUP BY l_orderkey, CAST(l_shipdate AS DATE)),
header AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS invoiceid, invoicedate, CAST(o_custkey AS VARCHAR) AS orderaccount,
    CAST(o_custkey AS VARCHAR) AS invoiceaccount, 'USD' AS currencycode,
    'LV' || CAST(l_orderkey AS VARCHAR) || '-' || strftime(invoicedate, '%Y%m%d') AS ledgervoucher,
    invoiceamount, invoiceamount AS invoiceamountmst, sumtax, sumtax AS sumtaxmst, '{d.COMPANY}' AS dataareaid
  FROM agg JOIN orders ON l_orderkey = o_orderkey)"""

PRICE = "CAST(o_totalprice AS DECIMAL(15,2))"
F1_TS, F2_TS = "TIMESTAMP '2024-01-01 00:00:00'", "TIMESTAMP '2024-01-02 13:30:00'"
TWO_RUNS = f"""SELECT o_orderkey AS recid, {F1_TS} AS SinkCreatedOn,
  CASE WHEN o_orderstatus = 'O' THEN {F2_TS} ELSE {F1_TS} END AS SinkModifiedOn,
  CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE false END AS IsDelete,
  CAST(CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '2-HIGH' THEN 3
            WHEN o_orderstatus = 'O' THEN 2 ELSE 1 END AS BIGINT) AS recversion,
  o_custkey, o_orderstatus,
  CAST(CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '2-HIGH' THEN {PRICE} + 2
            WHEN o_orderstatus = 'O' THEN {PRICE} + 1 ELSE {PRICE} END AS DECIMAL(38,6)) AS o_totalprice,
  o_orderdate, o_orderpriority, 'dat' AS dataareaid
FROM orders WHERE o_orderstatus <> 'P'
UNION ALL
SELECT o_orderkey + 1000000000, {F1_TS}, {F2_TS}, false, CAST(1 AS BIGINT), o_custkey, o_orderstatus,
  CAST({PRICE} AS DECIMAL(38,6)), o_orderdate, o_orderpriority, 'dat'
FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'"""

_IF = "count(*) FILTER (o_orderstatus = '{}' AND o_orderpriority LIKE '{}')"
RUN_LOG = f"""SELECT 1 AS run, 'orders' AS "table", 'loaded' AS status, count(*) AS source_rows, count(*) AS inserted,
  CAST(NULL AS BIGINT) AS updated, CAST(NULL AS BIGINT) AS deleted, CAST(NULL AS BIGINT) AS unchanged,
  CAST(NULL AS BIGINT) AS ignored, count(*) AS rows_after FROM orders
UNION ALL SELECT 2, 'orders', 'merged', {_IF.format('O', '%')} + {_IF.format('P', '%')} + {_IF.format('F', '1%')}
    + {_IF.format('F', '3%')} + {_IF.format('F', '5%')}, {_IF.format('F', '1%')}, {_IF.format('O', '%')},
  {_IF.format('P', '%')}, {_IF.format('F', '3%')}, {_IF.format('F', '5%')},
  count(*) - {_IF.format('P', '%')} + {_IF.format('F', '1%')} FROM orders
UNION ALL SELECT r, t, s, NULL, NULL, NULL, NULL, NULL, NULL, NULL
FROM (VALUES (1, 'absent', 'skipped'), (2, 'absent', 'skipped'), (1, 'unmodelled', 'failed'), (2, 'unmodelled', 'failed')) v(r, t, s)
"""


def oracle() -> dict[str, str]:
    li_tie = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
              "l_returnflag", "l_linestatus"]
    ch = changes_sql()
    return {
        "latest_event_per_user": (
            "SELECT event_id, ts, user_id, event_type, value, props FROM (SELECT *, row_number() OVER "
            "(PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) AS rn FROM events) e "
            "WHERE rn = 1"),
        "latest_lineitem": (
            "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, "
            "l_tax, l_returnflag, l_linestatus, l_shipdate FROM (SELECT *, row_number() OVER (PARTITION BY "
            f"l_orderkey, l_linenumber ORDER BY {_desc(['l_shipdate', *li_tie])}) AS rn FROM lineitem) x WHERE rn = 1"),
        "initial_load": latest_sql(ch, live_only=True),
        "merge_state": _std_merge("state"),
        "merge_state_broadcast": _std_merge("state"),
        "merge_actions": _std_merge("actions"),
        "change_feed": _std_merge("changes"),
        "merge_added_column": _added_column(),
        "merge_null_key": _std_merge("state", null_key="l_discount = 0"),
        "changed_rows": _changed_rows(),
        "enum_decode": (
            f"WITH lk AS (SELECT * FROM ({LOOKUP}) l WHERE entity = 'customer') "
            "SELECT c.c_custkey, c.c_name, l.label AS c_nationkey, c.c_acctbal, "
            "c.c_mktsegment, s.label AS c_state, t.label AS c_tier FROM customer c "
            "LEFT JOIN lk l ON l.attribute = 'c_nationkey' AND c.c_nationkey = l.code "
            "LEFT JOIN lk s ON s.attribute = 'c_state' AND c.c_custkey % 12 = s.code "
            "LEFT JOIN lk t ON t.attribute = 'c_tier' AND c.c_custkey % 25 = t.code"),
        "enum_case_list": (
            f"WITH lk AS ({LOOKUP}) SELECT entity, attribute, string_agg('when ' || CAST(code AS VARCHAR) || "
            "' then ''' || replace(label, '''', '''''') || '''', ' ' ORDER BY code) AS case_text "
            "FROM lk GROUP BY entity, attribute"),
        "record_id_decode": (
            "SELECT o_orderkey, lpad(lower(hex(o_custkey)), 8, '0') || '-0000-0000-' || substr(h, 15, 2) || "
            "substr(h, 13, 2) || '-' || substr(h, 11, 2) || substr(h, 9, 2) || substr(h, 7, 2) || "
            "substr(h, 5, 2) || substr(h, 3, 2) || substr(h, 1, 2) AS sl_id, o_orderkey AS recid, "
            "o_custkey AS tableid, CAST(NULL AS BIGINT) AS recid_topbit "
            "FROM (SELECT *, lpad(lower(hex(o_orderkey)), 16, '0') AS h FROM orders) o"),
        "table_id_decode": (
            "SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN o_custkey ELSE o_custkey + 1000000 END "
            "AS tableid, o_orderkey AS recid FROM orders"),
        "sink_timestamp_parse": (
            "SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(NULL AS TIMESTAMP) "
            "ELSE o_orderdate END AS SinkModifiedOn FROM orders"),
        "changelog_latest": f"SELECT l AS latest_folder FROM ({LATEST}) x",
        "closed_folders": (
            f"WITH ev AS ({EVENTS_FILES}) SELECT DISTINCT event_type AS \"table\", folder FROM ev "
            f"WHERE lower(ext) = '.csv' AND folder > '{d.FIRST_MARK}' AND folder < ({LATEST}) "
            f"AND folder NOT IN {SYSTEM}"),
        "incremental_slice": (
            f"{PLAN}, pairs AS (SELECT DISTINCT tbl, folder FROM plan) "
            "SELECT e.event_id, e.ts, e.user_id, e.event_type, e.value, e.folder FROM ev e "
            "JOIN pairs p ON e.event_type = p.tbl AND e.folder = p.folder"),
        "next_watermark": f"{PLAN} SELECT tbl AS tableName, max(folder) AS lastload FROM plan GROUP BY tbl",
        "table_selection": (
            "SELECT lower(s_name) AS table_name, 'pg_' || lower(n_name) AS processing_group FROM supplier "
            "JOIN nation ON s_nationkey = n_nationkey WHERE 'pg_' || lower(n_name) = 'pg_nation_7' "
            "OR lower(s_name) IN ('supplier#000000001', 'supplier#000000002')"),
        "schema_catalog": SCHEMA_CATALOG,
        "silver_customer": _customer("p.c_name"),
        "silver_customer_unmatched_party": _customer("p.c_name"),
        "silver_view_build": _customer("p.c_name"),
        "silver_sales_invoice": (
            f"{INVOICES} SELECT CAST(c.c_custkey AS VARCHAR) AS accountnum, c.c_nationkey AS custgroup, "
            "c.c_mktsegment AS dlvterm, c.c_custkey AS party, n.n_name AS customergroup, c.c_name AS customername, "
            "h.*, l.currencycode AS line_currencycode, l.salesid, l.linenum, l.itemid, "
            "l.qty, l.lineamount FROM header h JOIN lines l ON h.invoiceid = l.invoiceid AND "
            "h.invoicedate = l.invoicedate AND h.dataareaid = l.dataareaid "
            "JOIN customer c ON CAST(c.c_custkey AS VARCHAR) = h.invoiceaccount "
            "JOIN nation n ON n.n_nationkey = c.c_nationkey"),
        "invoice_header_profile": (
            f"{INVOICES} SELECT invoiceid, invoicedate, orderaccount, invoiceaccount, currencycode, "
            "ledgervoucher, invoiceamount, invoiceamountmst, sumtax, sumtaxmst, dataareaid FROM header"),
        "invoice_line_profile": (
            f"{INVOICES} SELECT invoiceid, invoicedate, currencycode, salesid, linenum, itemid, qty, "
            "lineamount, dataareaid FROM lines"),
        "name_check_violations": (
            f"SELECT * FROM ({_customer('CASE WHEN p.c_acctbal >= 0 THEN p.c_name END')}) v "
            "WHERE NOT coalesce(customername <> '', false)"),
        "csv_ranges": ("SELECT doc_id, CASE WHEN doc_id % 2 = 1 THEN replace(text, chr(10), chr(13) || chr(10)) "
                       "ELSE text END AS text, lang, source, n_chars FROM documents"),
        "csv_bad_rows": (
            "WITH f AS (SELECT *, o_orderkey % 32 AS kind, '\"' || o_orderkey || '\"' AS a, '\"' || o_custkey || '\"' AS b, "
            "'\"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%fZ') || '\"' AS c, '\"' || o_orderpriority || '\"' AS d FROM orders) "
            "SELECT o_orderkey, CASE WHEN kind <> 3 THEN o_custkey END AS o_custkey, kind IN (1, 4) AS no_date, "
            "CASE WHEN kind <> 1 THEN o_orderpriority END AS o_orderpriority, "
            "CASE kind WHEN 1 THEN a || ',' || b WHEN 2 THEN a || ',' || b || ',' || c || ',' || d || ',\"more\"' "
            "WHEN 3 THEN a || ',\"x1\",' || c || ',' || d WHEN 4 THEN 'o_orderdate=some day' END AS bad_record FROM f"),
        "csv_round_trip": ("SELECT doc_id, CASE WHEN doc_id % 2 = 1 THEN replace(text, chr(10), chr(13) || chr(10)) "
                           "ELSE text END AS text, lang, source, n_chars FROM documents"),
        "config_scan": (
            "SELECT lower(s_name) AS table_name, 'pg_' || lower(n_name) AS processing_group FROM supplier "
            "JOIN nation ON s_nationkey = n_nationkey WHERE 'pg_' || lower(n_name) = 'pg_nation_3'"),
        "merge_stored_table": _std_merge("state"),
        "stored_change_feed": (
            f"SELECT {', '.join(STATE_COLS)}, 'insert' AS _change_type FROM ({latest_sql(ch, FIRST, live_only=True)}) i "
            f"UNION ALL SELECT {', '.join(STATE_COLS)}, _change_type FROM ({_std_merge('changes')}) c"),
        "net_changes": _net_changes(),
        "stored_added_column": _added_column(),
        "load_stamps": (
            "SELECT recid, true AS created_first, true AS within_run, CASE WHEN action = 'insert' THEN 'insert' "
            f"WHEN action = 'update' THEN 'update' ELSE 'keep' END AS written FROM ({_std_merge('joined')}) j "
            "WHERE action IN ('keep', 'unchanged', 'update', 'insert')"),
        "ingest_two_runs": TWO_RUNS,
        "stream_state": TWO_RUNS,
        "reload_state": TWO_RUNS.replace(
            f"CASE WHEN o_orderstatus = 'O' THEN {F2_TS}",
            f"CASE WHEN o_orderstatus = 'O' OR (o_orderstatus = 'F' AND o_orderpriority = '3-MEDIUM') THEN {F2_TS}"),
        "run_log": RUN_LOG,
    }
