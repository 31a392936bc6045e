import os

from pyspark.sql import functions as F

from tidemark.sources.landing import (changelog_head, changelog_latest, closed_folders, landing_files,
                                      plan_loads, table_folders)


def touch(path, data=b"x\r\n"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


def build(root):
    for p in ["2024-01-01T00.00.00Z/cust/a.csv", "2024-01-02T00.00.00Z/cust/b.CSV",
              "2024-01-02T00.00.00Z/group/readme.txt", "2024-01-03T00.00.00Z/cust/c.csv",
              "2024-01-03T00.00.00Z/group/g.csv", "2024-01-04T00.00.00Z/cust/d.csv",
              "EntitySyncFailure/cust/e.csv", "Microsoft.Athena.TrickleFeedService/cust/f.csv"]:
        touch(f"{root}/{p}")
    touch(f"{root}/model.json", b"{}")
    touch(f"{root}/Changelog/changelog.info", b"2024-01-04T00.00.00Z")


def test_listing_and_rules(spark, tmp_dir):
    build(tmp_dir)
    files = landing_files(spark, tmp_dir)
    assert files.filter(F.col("file_name") == "b.CSV").select("folder", "table").first() == \
        ("2024-01-02T00.00.00Z", "cust")
    latest = changelog_head(spark, f"{tmp_dir}/Changelog/changelog.info")
    assert latest == "2024-01-04T00.00.00Z"
    # strictly after the mark, strictly before the open folder, system folders out
    got = sorted(r[0] for r in closed_folders(files, "2024-01-01T00.00.00Z", latest).collect())
    assert got == ["2024-01-02T00.00.00Z", "2024-01-03T00.00.00Z"]
    got = sorted(r[0] for r in closed_folders(files, None, None).collect())
    assert "EntitySyncFailure" not in got and "model.json" not in got and "Changelog" not in got
    pairs = sorted(map(tuple, table_folders(files).collect()))
    assert ("group", "2024-01-02T00.00.00Z") not in pairs           # no CSV file there
    assert ("cust", "2024-01-02T00.00.00Z") in pairs                # .CSV counts
    plan = plan_loads(files, {"cust": "2024-01-01T00.00.00Z", "group": None}, latest)
    got = sorted((r["table"], r["folder"]) for r in plan.collect())
    assert got == [("cust", "2024-01-02T00.00.00Z"), ("cust", "2024-01-03T00.00.00Z"),
                   ("group", "2024-01-03T00.00.00Z")]


def test_changelog_latest_and_empty(spark, tmp_dir):
    touch(f"{tmp_dir}/Changelog/changelog.info", b"2024-01-02T00.00.00Z,2024-01-09T00.00.00Z,2024-01-03T00.00.00Z")
    assert changelog_latest(spark, f"{tmp_dir}/Changelog/changelog.info") == "2024-01-09T00.00.00Z"
    touch(f"{tmp_dir}/empty/Changelog/changelog.info", b"")
    assert changelog_head(spark, f"{tmp_dir}/empty/Changelog/changelog.info") is None
    assert changelog_latest(spark, f"{tmp_dir}/empty/Changelog/changelog.info") is None


def test_load_listing_follows_each_tables_mark(spark, tmp_dir):
    from tidemark.sources.landing import loadable_folders
    build(tmp_dir)
    d = "2024-01-0{}T00.00.00Z".format
    marks = {"cust": d(2), "group": None, "absent": None}
    assert loadable_folders(spark, tmp_dir, marks, d(4)) == {"cust": [d(3)], "group": [d(3)], "absent": []}
    assert loadable_folders(spark, tmp_dir, {"cust": None}, d(3)) == {"cust": [d(1), d(2)]}      # .CSV counts
    assert loadable_folders(spark, tmp_dir, {"cust": None}, None)["cust"] == [d(1), d(2), d(3), d(4)]


def test_listing_finds_what_probes_find(spark, tmp_dir, monkeypatch):
    import random
    from tidemark.sources import landing
    rng = random.Random(3)
    folders = [f"2024-{m:02}-01T00.00.00Z" for m in range(1, 13)]
    tables = [f"t{k}" for k in range(9)]
    for f in folders:
        touch(f"{tmp_dir}/{f}/model.json")
        touch(f"{tmp_dir}/{f}/loose.csv")                                 # of no table
        for t in tables:
            what = rng.choice(["none", "csv", "CSV", "txt", "deep"])
            if what != "none":
                touch(f"{tmp_dir}/{f}/{t}/" + {"deep": "x/a.csv", "txt": "a.txt"}.get(what, f"a.{what}"))
    build(tmp_dir)
    for marks in ({t: rng.choice([None, *folders]) for t in tables} | {"absent": None}, {t: folders[6] for t in tables}):
        for latest in (None, folders[9]):
            monkeypatch.setattr(landing, "PROBES", 10 ** 9)
            want = landing.loadable_folders(spark, tmp_dir, marks, latest)
            monkeypatch.setattr(landing, "PROBES", 0)
            monkeypatch.setattr(landing, "LISTED_FOLDERS", 5)             # several listings
            assert landing.loadable_folders(spark, tmp_dir, marks, latest) == want
            assert any(want.values())


def test_requests_follow_the_folders(spark, tmp_dir, monkeypatch):
    """Many tables and folders: no request of the driver per pair; the listing runs as a Spark job over the folders."""
    from tidemark.sources import landing
    folders = [f"2024-01-{k:02}T00.00.00Z" for k in range(1, 29)] + [f"2024-02-{k:02}T00.00.00Z" for k in range(1, 13)]
    for f in folders:
        touch(f"{tmp_dir}/{f}/t1/a.csv")
    metrics = spark._jvm.org.apache.spark.metrics.source.HiveCatalogMetrics
    jobs, files = metrics.METRIC_PARALLEL_LISTING_JOB_COUNT(), metrics.METRIC_FILES_DISCOVERED()

    def listed(tables):
        before = jobs.getCount(), files.getCount()
        got = landing.loadable_folders(spark, tmp_dir, {f"t{k}": None for k in range(tables)}, None)
        assert got["t1"] == folders and not any(v for t, v in got.items() if t != "t1")
        return jobs.getCount() - before[0], files.getCount() - before[1]

    monkeypatch.setattr(landing, "_probed", lambda *a: 1 / 0)
    few, many = listed(2), listed(200)                  # 80 and 8,000 pairs
    assert few == many and few[0] == 1 and few[1] == len(folders)


def test_a_new_table_does_not_list_other_tables_history(spark, tmp_dir):
    """Only <folder>/<table> past the table's own mark is looked into, and no Spark task lists files."""
    import shutil
    from tidemark.sources.landing import loadable_folders
    build(tmp_dir)
    shutil.rmtree(f"{tmp_dir}/2024-01-01T00.00.00Z/cust")
    touch(f"{tmp_dir}/2024-01-01T00.00.00Z/cust")             # a file where old history was: listing it would fail
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    marks = {"cust": "2024-01-03T00.00.00Z", "group": None}
    assert loadable_folders(spark, tmp_dir, marks, None) == {
        "cust": ["2024-01-04T00.00.00Z"], "group": ["2024-01-03T00.00.00Z"]}
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == jobs


def test_current_all_reads_log_once(spark, tmp_dir):
    from tidemark.sinks.store import TableStore
    store = TableStore(spark, tmp_dir)
    store.commit("a", "/p/a1", "f1", "r1", "replace", 1)
    store.commit("a", "/p/a2", "f2", "r2", "merge", 1)
    store.commit("b", "/p/b1", "f9", "r3", "replace", 1)
    got = {t: (s.path, s.lastload) for t, s in store.current_all().items()}
    assert got == {"a": ("/p/a2", "f2"), "b": ("/p/b1", "f9")}
    assert set(store.current_all(["b", "zz"])) == {"b"}
    assert store.current("a").lastload == "f2" and store.current("zz") is None


def test_unreadable_load_log_is_an_error_not_a_missing_mark(spark, tmp_dir):
    """Only "no log yet" means no high-water mark; a broken log must not
    silently turn the next load into a full reload."""
    import pytest
    from tidemark.sinks.store import TableStore
    store = TableStore(spark, tmp_dir)
    assert store.current("t") is None                        # no log yet
    touch(f"{tmp_dir}/_log/table=t/part-0.parquet", b"not parquet")
    for read in (lambda: store.current("t"), lambda: store.current_all(["t"]), lambda: store.changes("t")):
        with pytest.raises(Exception):
            read()
