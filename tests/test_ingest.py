import json
import os

import pytest

from tidemark.config import LandingConfig
from tidemark.plans.ingest import ingest_all, ingest_table, load_enums, run_outcome
from tidemark.sinks.store import TableStore

F1, F2, F3 = "2024-01-01T00.00.00Z", "2024-01-02T00.00.00Z", "2024-01-03T00.00.00Z"
ATTRS = [("Id", "guid"), ("SinkCreatedOn", "datetime"), ("SinkModifiedOn", "datetime"), ("IsDelete", "boolean"),
         ("recid", "int64"), ("tableid", "int64"), ("versionnumber", "int64"), ("recversion", "int64"),
         ("createdtransactionid", "int64"), ("modifiedtransactionid", "int64"), ("accountnum", "string"),
         ("blocked", "int32"), ("createdon", "datetime"), ("dataareaid", "string")]


def guid(recid):
    h = f"{recid:016x}"
    return f"00000077-0000-0000-{h[14:16]}{h[12:14]}-{h[10:12]}{h[8:10]}{h[6:8]}{h[4:6]}{h[2:4]}{h[0:2]}"


def line(recid, version, account, blocked=1, delete="False", keep_recid=True, extra=None,
         modified="1/1/2024 10:00:00 AM"):
    fields = [f'"{guid(recid)}"', '"1/1/2024 9:00:00 AM"', f'"{modified}"', delete,
              str(recid) if keep_recid else "", "", str(version), "1", "0", "0", f'"{account}"',
              str(blocked), "2023-12-31T23:59:59.1234567Z", '"dat"']
    if extra is not None:
        fields.append(f'"{extra}"')
    return ",".join(fields)


def write(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(("\r\n".join(lines) + "\r\n").encode())


def model(root, extra=False):
    attrs = ATTRS + ([("newcol", "string")] if extra else [])
    doc = {"entities": [{"name": "custtable", "attributes": [{"name": a, "dataType": t} for a, t in attrs]}]}
    os.makedirs(root, exist_ok=True)
    with open(f"{root}/model.json", "w") as f:
        json.dump(doc, f, indent=2)


def changelog(root, text):
    write(f"{root}/Changelog/changelog.info", [text])


ENUMS = ['blocked,1,False,1033,"No",b,custtable,"No"', 'blocked,1,False,1031,"Nein",b,custtable,"Nein"',
         "blocked,2,False,1033,\"It's\",b,custtable,\"It's\"", 'blocked,3,False,1033,,b,custtable,',
         'missingattr,1,False,1033,"M",m,custtable,"M"', 'blocked,1,False,1033,"Other",b,othertable,"Other"']


def landing(root):
    model(root)
    write(f"{root}/{F1}/custtable/part1.csv", [
        line(101, 1, "A1"), line(102, 1, "B1", keep_recid=False),
        line(103, 1, "C-old"), line(103, 3, "C-new", blocked=2), line(103, 2, "C-mid"),
        line(104, 1, "D1"), line(104, 2, "D1", delete="True"), line(106, 1, "F1", blocked=5)])
    write(f"{root}/{F2}/custtable/part1.CSV", [
        line(101, 2, "A2", extra="n1"), line(102, 2, "B1", delete="True", keep_recid=False, extra=""),
        line(105, 1, "E1", extra="n5"), line(999, 1, "Z", delete="True", extra=""),
        line(103, 4, "C-new", blocked=2, modified="1/2/2024 10:00:00 AM", extra=None)])
    write(f"{root}/{F3}/custtable/part1.csv", [line(101, 9, "OPEN", delete="True")])
    for folder in (F2, F3):
        write(f"{root}/{folder}/OptionsetMetadata/GlobalOptionsetMetadata.csv", ENUMS)


def state(store):
    return {r["recid"]: r for r in store.read("custtable").collect()}


def test_two_runs_skip_and_reload(spark, tmp_dir):
    root, store_root = f"{tmp_dir}/landing", f"{tmp_dir}/bronze"
    landing(root)
    cfg = LandingConfig(landing_root=root, store_root=store_root)
    store = TableStore(spark, store_root)

    changelog(root, F2)
    assert load_enums(spark, cfg, store) is not None
    r1 = ingest_table(spark, cfg, "custtable", store=store)
    assert r1["status"] == "loaded" and r1["folder_to"] == F1
    s1 = state(store)
    assert set(s1) == {101, 102, 103, 106}                 # 104's latest change is a delete
    assert s1[102]["accountnum"] == "B1"                   # recid repaired from the GUID
    assert s1[103]["accountnum"] == "C-new" and s1[103]["blocked"] == "It's"
    assert s1[101]["blocked"] == "Nein"                    # two labels: the smallest wins
    assert s1[106]["blocked"] is None                      # unlisted code
    assert "sl_id" not in s1[101] and "versionnumber" not in s1[101] and "tableid" not in s1[101]
    assert s1[101]["SinkModifiedOn"] is not None and s1[101]["createdon"].microsecond == 123456
    assert store.watermark("custtable") == F1

    changelog(root, F3)
    model(root, extra=True)
    r2 = ingest_table(spark, cfg, "custtable", store=store)
    assert r2["status"] == "merged" and r2["folder_from"] == F2 == r2["folder_to"]
    assert (r2["inserted"], r2["updated"], r2["deleted"], r2["ignored"], r2["unchanged"]) == (1, 1, 1, 1, 1)
    s2 = state(store)
    assert set(s2) == {101, 103, 105, 106}
    assert s2[101]["accountnum"] == "A2" and s2[101]["newcol"] == "n1"
    assert s2[106]["newcol"] is None
    assert s2[103]["SinkModifiedOn"] == s1[103]["SinkModifiedOn"]   # unchanged row untouched
    assert s2[101]["_sysCreatedDateTime"] == s1[101]["_sysCreatedDateTime"]
    assert store.watermark("custtable") == F2
    feed = sorted((r["recid"], r["_change_type"]) for r in store.changes("custtable").collect()
                  if r["_change_type"] != "insert" or r["recid"] == 105)
    assert feed == [(101, "update_postimage"), (101, "update_preimage"), (102, "delete"), (105, "insert")]

    r3 = ingest_table(spark, cfg, "custtable", store=store)
    assert r3["status"] == "skipped" and store.watermark("custtable") == F2

    r4 = ingest_table(spark, cfg, "custtable", reload=True, store=store)
    assert r4["status"] == "loaded" and r4["folder_from"] == F1 and r4["folder_to"] == F2
    assert set(state(store)) == set(s2)


def test_ingest_all_records_failures(spark, tmp_dir):
    root, store_root = f"{tmp_dir}/landing", f"{tmp_dir}/bronze"
    landing(root)
    write(f"{root}/{F1}/notinmodel/x.csv", ["1,2"])
    changelog(root, F2)
    cfg = LandingConfig(landing_root=root, store_root=store_root)
    load_enums(spark, cfg)
    config = spark.createDataFrame([("custtable", "daily"), ("notinmodel", "daily"), ("other", "weekly")],
                                   "table_name STRING, processing_group STRING")
    run_log = ingest_all(spark, cfg, config, processing_group="daily", parallelism=2)
    log = {r["table"]: r for r in run_log.collect()}
    assert set(log) == {"custtable", "notinmodel"}
    assert log["custtable"]["status"] == "loaded"
    assert log["notinmodel"]["status"] == "failed" and "not in the model" in log["notinmodel"]["error"]
    outcome = run_outcome(run_log)
    assert outcome == {"result": "FAIL", "errors": 1}
    assert TableStore(spark, store_root).read("custtable").count() == 4


def test_replay_is_idempotent_and_older_change_wins_later(spark, tmp_dir):
    """Replaying the same change set changes nothing; an older version that
    arrives in a later folder still overwrites (versions are not stored)."""
    from tidemark.plans.ingest import apply_changes, enum_table, plan_tables, read_changes
    root, store_root = f"{tmp_dir}/landing", f"{tmp_dir}/bronze"
    landing(root)
    changelog(root, F2)
    cfg = LandingConfig(landing_root=root, store_root=store_root)
    store = TableStore(spark, store_root)
    load_enums(spark, cfg, store)
    ingest_table(spark, cfg, "custtable", store=store)
    before = sorted(tuple(r[c] for c in ("recid", "accountnum", "blocked")) for r in store.read("custtable").collect())
    folders = plan_tables(spark, cfg, store, ["custtable"], reload=True)["custtable"]
    again = read_changes(spark, cfg, "custtable", folders, enum_table(store))
    r = apply_changes(spark, cfg, store, "custtable", again, F1, F1)
    assert (r["inserted"], r["updated"], r["deleted"]) == (0, 0, 0) and r["unchanged"] == 4
    after = sorted(tuple(r[c] for c in ("recid", "accountnum", "blocked")) for r in store.read("custtable").collect())
    assert after == before

    write(f"{root}/{F2}/custtable/late.csv", [line(106, 0, "F-stale")])     # version 0 < stored version 1
    changelog(root, F3)
    ingest_table(spark, cfg, "custtable", store=store)
    assert {r["recid"]: r["accountnum"] for r in store.read("custtable").collect()}[106] == "F-stale"


def test_enum_metadata_must_be_loaded(spark, tmp_dir):
    root = f"{tmp_dir}/landing"
    landing(root)
    changelog(root, F2)
    cfg = LandingConfig(landing_root=root, store_root=f"{tmp_dir}/bronze")
    store = TableStore(spark, cfg.store_root)
    with pytest.raises(ValueError, match="_enum_translations"):
        ingest_table(spark, cfg, "custtable", store=store)
    assert store.current("custtable") is None
    # Codes only, on request; labels that arrive later don't fit the stored codes and need a reload.
    codes = LandingConfig(landing_root=root, store_root=cfg.store_root, decode_enums=False)
    assert ingest_table(spark, codes, "custtable", store=store)["status"] == "loaded"
    assert state(store)[101]["blocked"] == 1
    load_enums(spark, cfg, store)
    changelog(root, F3)
    with pytest.raises(ValueError, match="blocked: string into int"):
        ingest_table(spark, cfg, "custtable", store=store)
    assert store.watermark("custtable") == F1
    assert ingest_table(spark, cfg, "custtable", reload=True, store=store)["status"] == "loaded"
    assert state(store)[101]["blocked"] == "Nein"


def test_late_file_of_an_older_folder_does_not_move_the_mark_back(spark, tmp_dir):
    from tidemark.plans.ingest import apply_changes
    cfg = LandingConfig(landing_root="", store_root=tmp_dir, version_order=("v",))
    store = TableStore(spark, tmp_dir)
    rows = lambda *r: spark.createDataFrame(r, "RECID BIGINT, v INT, IsDelete BOOLEAN")
    apply_changes(spark, cfg, store, "t", rows((1, 1, None)), F2, F2)
    apply_changes(spark, cfg, store, "t", rows((2, 1, None)), F1, F1)
    assert store.watermark("t") == F2 and store.read("t").count() == 2


def test_unknown_types_are_reported(spark, tmp_dir):
    root = f"{tmp_dir}/landing"
    landing(root)
    doc = json.load(open(f"{root}/model.json"))
    doc["entities"][0]["attributes"][10]["dataType"] = "money"
    json.dump(doc, open(f"{root}/model.json", "w"))
    changelog(root, F2)
    cfg = LandingConfig(landing_root=root, store_root=f"{tmp_dir}/bronze")
    load_enums(spark, cfg)
    config = spark.createDataFrame([("custtable", "g")], "table_name STRING, processing_group STRING")
    r = ingest_all(spark, cfg, config).first()
    assert r["status"] == "loaded" and r["warning"] == "unknown types read as string: accountnum: money"


def test_nothing_to_load_leaves_store_untouched(spark, tmp_dir):
    root, store_root = f"{tmp_dir}/landing", f"{tmp_dir}/bronze"
    landing(root)
    changelog(root, F1)                                     # only the open folder exists before it
    cfg = LandingConfig(landing_root=root, store_root=store_root)
    store = TableStore(spark, store_root)
    assert ingest_table(spark, cfg, "custtable", store=store)["status"] == "skipped"
    assert store.current("custtable") is None and store.watermark("custtable") is None
    write(f"{root}/Changelog/changelog.info", [""])
    os.makedirs(f"{tmp_dir}/empty", exist_ok=True)
    empty_cfg = LandingConfig(landing_root=f"{tmp_dir}/empty", store_root=store_root)
    write(f"{tmp_dir}/empty/Changelog/changelog.info", [])
    assert load_enums(spark, empty_cfg, store) is None     # empty changelog: no enum folder


def test_command_line_run(spark, tmp_dir, capsys):
    from tidemark.__main__ import main
    root = f"{tmp_dir}/landing"
    landing(root)
    changelog(root, F2)
    spark.createDataFrame([("custtable", "daily")], "table_name STRING, processing_group STRING") \
        .write.parquet(f"{tmp_dir}/cfg")
    code = main(["--landing", root, "--store", f"{tmp_dir}/bronze", "--config", f"{tmp_dir}/cfg",
                 "--group", "daily"], spark=spark)
    out = capsys.readouterr().out
    assert code == 0 and "custtable: loaded" in out and "PASS: 0 error(s)" in out


def test_bad_records_are_stored_and_counted(spark, tmp_dir):
    root = f"{tmp_dir}/landing"
    landing(root)
    changelog(root, F3)
    write(f"{root}/{F2}/custtable/bad.csv", [line(901, 1, "Z1"), line(902, 1, "Z2", extra="more"),
                                             line(903, 1, "Z3").replace("2023-12-31T23", "junk"), '"short"'])
    cfg = LandingConfig(landing_root=root, store_root=f"{tmp_dir}/s", csv_range_bytes=200)     # files of any size alike
    load_enums(spark, cfg)
    rows = ingest_table(spark, cfg, "custtable")
    assert rows["status"] == "loaded" and rows["bad_rows"] == 7          # four have a field that this model lacks
    store = TableStore(spark, cfg.store_root)
    bad = store.bad_records("custtable").collect()
    assert {r["_folder"] for r in bad} == {F2} and {r["_run_id"] for r in bad} == {rows["run_id"]}
    assert len(bad) == 7 and {r["_bad_record"] for r in bad} >= {
        '"short"', line(902, 1, "Z2", extra="more"), "createdon=junk:59:59.1234567Z"}
    assert {901, 902, 903} <= {r["recid"] for r in store.read("custtable").collect()}          # loaded as before
    (skipped,) = ingest_all(spark, cfg, spark.createDataFrame([("custtable", "g")], "table_name string, processing_group string")).collect()
    assert skipped["status"] == "skipped" and skipped["bad_rows"] is None
    assert TableStore(spark, f"{tmp_dir}/none").bad_records("custtable").collect() == []


def test_a_hanging_table_is_stopped_and_the_others_commit(spark, tmp_dir, monkeypatch):
    import time

    from pyspark.sql import functions as F
    from tidemark.plans import ingest
    root = f"{tmp_dir}/landing"
    landing(root)
    changelog(root, F2)
    write(f"{root}/{F1}/slow/a.csv", [line(1, 1, "S")])
    doc = json.load(open(f"{root}/model.json"))
    doc["entities"].append({"name": "slow", "attributes": doc["entities"][0]["attributes"]})
    json.dump(doc, open(f"{root}/model.json", "w"))
    cfg = LandingConfig(landing_root=root, store_root=f"{tmp_dir}/s", table_seconds=25)
    load_enums(spark, cfg)
    prepare, pools = ingest.prepare_changes, {}

    @F.udf("boolean")
    def wait(_):
        time.sleep(300)
        return True

    def hanging(rows, cfg, table, enums):
        pools[table] = spark.sparkContext.getLocalProperty("spark.scheduler.pool")
        out = prepare(rows, cfg, table, enums)
        return out.where(wait("recid")) if table == "slow" else out

    monkeypatch.setattr(ingest, "prepare_changes", hanging)
    began = time.time()
    config = spark.createDataFrame([("custtable", "g"), ("slow", "g")], "table_name string, processing_group string")
    log = {r["table"]: r for r in ingest_all(spark, cfg, config).collect()}
    assert time.time() - began < 120
    assert log["custtable"]["status"] == "loaded" and log["slow"]["status"] == "failed"
    assert log["slow"]["error"].startswith("stopped after 25 s")
    store = TableStore(spark, cfg.store_root)
    assert store.exists("custtable") and not store.exists("slow")
    assert pools == {"custtable": "custtable", "slow": "slow"}
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None


def test_nothing_is_committed_once_stopped(spark, tmp_dir):
    import threading

    from tidemark.plans.ingest import apply_changes
    cfg = LandingConfig(landing_root="", store_root=f"{tmp_dir}/s")
    store, stopped = TableStore(spark, cfg.store_root), threading.Event()
    stopped.set()
    rows = spark.sql("SELECT 1L AS RECID, false AS IsDelete")
    with pytest.raises(RuntimeError, match="stopped"):
        apply_changes(spark, cfg, store, "t", rows, "f", "f", stopped=stopped)
    assert not store.exists("t")


def test_enum_attributes_with_many_codes(spark):
    """Over the limit an attribute is joined, with the same labels as in one projection."""
    from tidemark.functions.enums import decode_enums
    enums = spark.range(50).selectExpr("explode(array('a', 'b', 'c')) AS OptionSetName", "id AS Option", "'t' AS EntityName",
                                       "concat(OptionSetName, id % 7) AS OptionName", "id")
    enums = enums.where("OptionSetName <> 'c' or id < 3")
    enums = enums.unionByName(enums.selectExpr("OptionSetName", "Option", "EntityName", "'zz' AS OptionName", "id"))
    rows = spark.range(300).selectExpr("id", "cast(id % 60 AS INT) AS A", "if(id % 5 = 0, NULL, id % 53) AS b", "id % 4 AS c")
    one = sorted(map(tuple, decode_enums(rows, enums, "t").collect()))
    joined = decode_enums(rows, enums, "t", inline_codes=10)
    assert sorted(map(tuple, joined.collect())) == one and joined.columns == rows.columns
    assert joined._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter") == 2
    assert one[3] == (3, "a3", "b3", None) and one[61] == (61, "a1", "b1", "c1") and one[5][2] is None
