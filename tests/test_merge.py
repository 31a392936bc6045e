import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.merge import ACTION, merge

T_DDL = "RECID BIGINT, a BIGINT, b STRING, IsDelete BOOLEAN, SinkModifiedOn BIGINT"
S_DDL = "RECID BIGINT, a BIGINT, b STRING, IsDelete BOOLEAN, SinkModifiedOn BIGINT"


def python_merge(target, source):
    """Plain statement of the rule: upsert non-deletes (update only when a
    compared column differs), then delete matched delete markers."""
    def same_key(x, y):
        return x == y  # None == None is True: NULL-safe
    state = [dict(r) for r in target]
    for s in source:
        match = [t for t in state if same_key(t["RECID"], s["RECID"])]
        deleting = bool(s["IsDelete"])
        if deleting:
            for t in match:
                state.remove(t)
            continue
        if not match:
            state.append(dict(s))
        else:
            t = match[0]
            if any(t[c] != s[c] for c in ("a", "b", "IsDelete")):
                t.update({c: s[c] for c in ("a", "b", "IsDelete", "SinkModifiedOn")})
    return sorted((tuple(r[c] for c in ("RECID", "a", "b", "IsDelete", "SinkModifiedOn")) for r in state),
                  key=repr)


def rnd_rows(rnd, keys, with_delete):
    rows = []
    for k in keys:
        rows.append({"RECID": k, "a": rnd.choice([None, 1, 2]), "b": rnd.choice([None, "x", "y"]),
                     "IsDelete": rnd.choice([None, False, True]) if with_delete else rnd.choice([None, False]),
                     "SinkModifiedOn": rnd.randint(0, 3)})
    return rows


@pytest.mark.parametrize("strategy", ["shuffle", "broadcast"])
def test_random_merges_equal_rule(spark, strategy):
    rnd = random.Random(11 if strategy == "shuffle" else 12)
    for _ in range(12):
        pool = [None] + list(range(8))
        tkeys = rnd.sample(pool, rnd.randint(0, 6))
        skeys = rnd.sample(pool, rnd.randint(0, 6))
        target, source = rnd_rows(rnd, tkeys, False), rnd_rows(rnd, skeys, True)
        t = spark.createDataFrame([tuple(r.values()) for r in target], T_DDL)
        s = spark.createDataFrame([tuple(r.values()) for r in source], S_DDL)
        got = sorted(map(tuple, merge(t, s, ["RECID"], strategy=strategy).state.collect()), key=repr)
        assert got == python_merge(target, source), (target, source)


def test_value_moving_between_columns_is_a_change(spark):
    t = spark.createDataFrame([(1, 5, None, None, 0)], "RECID BIGINT, a BIGINT, c BIGINT, IsDelete BOOLEAN, SinkModifiedOn BIGINT")
    s = spark.createDataFrame([(1, None, 5, None, 0)], "RECID BIGINT, a BIGINT, c BIGINT, IsDelete BOOLEAN, SinkModifiedOn BIGINT")
    res = merge(t, s, ["RECID"])
    assert res.actions.select(ACTION).first()[0] == "update"
    # the 32-bit column hash cannot tell these rows apart
    assert spark.sql("select hash(5, null) = hash(null, 5)").first()[0]


def test_evolution_change_feed_and_stamps(spark):
    t = spark.createDataFrame([(1, "a", "keep-me"), (2, "b", "t2"), (3, "c", "t3")],
                              "RECID BIGINT, v STRING, t_only STRING")
    s = spark.createDataFrame([(1, "A", 10, None), (3, "c", 30, True), (4, "d", 40, False), (9, "z", 0, True)],
                              "recid BIGINT, v STRING, s_new INT, IsDelete BOOLEAN")
    res = merge(t, s, ["RECID"], stamp=True)
    state = {r["RECID"]: r for r in res.state.collect()}
    assert set(state) == {1, 2, 4}
    assert state[1]["v"] == "A" and state[1]["t_only"] == "keep-me" and state[1]["s_new"] == 10
    assert state[2]["s_new"] is None and state[4]["t_only"] is None
    assert state[2]["_sysCreatedDateTime"] is None                       # untouched row keeps its (empty) stamp
    assert state[4]["_sysCreatedDateTime"] is not None and state[1]["_sysProcessedDateTime"] is not None
    assert state[1]["_sysCreatedDateTime"] is None                       # created stamp preserved on update
    feed = sorted((r["RECID"], r["_change_type"]) for r in res.changes.collect())
    assert feed == [(1, "update_postimage"), (1, "update_preimage"), (3, "delete"), (4, "insert")]
    counts = {r[ACTION]: r["rows"] for r in res.action_counts().collect()}
    assert counts == {"update": 1, "keep": 1, "delete": 1, "insert": 1, "ignore": 1}


def test_broadcast_strategy_never_shuffles_target(spark):
    t = spark.range(0, 10000).select(F.col("id").alias("RECID"), F.lit("x").alias("v"))
    s = spark.createDataFrame([(1, "y", None)], "RECID BIGINT, v STRING, IsDelete BOOLEAN")
    plan = merge(t, s, ["RECID"], strategy="broadcast").state._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_strategy_needs_both_limits():
    from tidemark.operators.merge import choose_strategy
    assert choose_strategy(10, 1000, 100, 10_000) == "broadcast"
    assert choose_strategy(1000, 1000, 100, 10_000) == "shuffle"
    assert choose_strategy(10, 100_000, 100, 10_000) == "shuffle"


def test_bucketed_target_is_not_exchanged(spark, tmp_dir):
    from tidemark.session import stage_measured
    from tidemark.sinks.store import TableStore
    store = TableStore(spark, tmp_dir)
    t = spark.range(0, 5000).select(F.col("id").alias("RECID"), (F.col("id") % 7).alias("a"))
    path = store.write_snapshot("t", t.repartition(8, "RECID"), "r1", "RECID", 8)
    store.commit("t", path, "f1", "r1", "replace", 5000, None, 8, "RECID")
    src = spark.createDataFrame([(1, 9, None), (7000, 1, None), (None, 1, None)],
                                "RECID BIGINT, a BIGINT, IsDelete BOOLEAN")
    staged = stage_measured(src, "test-src")[0]
    res = merge(store.read("t"), staged, ["RECID"], strategy="shuffle")
    plan = res.state._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan
    assert "Exchange hashpartitioning(__t_RECID" not in plan      # only the change set moves
    state = {r["RECID"]: r["a"] for r in res.state.collect()}
    assert len(state) == 5002 and state[1] == 9 and state[7000] == 1 and state[None] == 1
    from test_latest import _shuffle_records
    out = res.state
    out.write.format("noop").mode("overwrite").save()
    assert _shuffle_records(out) <= 3 + 1          # the change set (+ the NULL-key row), not the 5000 stored rows


def loader(spark, tmp_dir, **kw):
    from tidemark.config import LandingConfig
    from tidemark.plans.ingest import apply_changes
    from tidemark.sinks.store import TableStore
    cfg = LandingConfig(landing_root="", store_root=tmp_dir, version_order=("a",), excluded_meta=(), **kw)
    store = TableStore(spark, tmp_dir)
    return store, lambda rows, folder: apply_changes(spark, cfg, store, "t", rows, folder, folder)


def state_files(store):
    import glob
    return glob.glob(store.current("t").path.replace("file:", "") + "/*.parquet")


def test_bucket_count_follows_the_rows_in_memory(spark, tmp_dir):
    """Rows that are stored in next to no bytes, as they are alike, still take memory where a bucket is joined and sorted."""
    store, load = loader(spark, tmp_dir, bucket_memory=100_000)
    rows = lambda a, b, text: spark.range(a, b).select(F.col("id").alias("RECID"), F.lit(text).alias("a"),
                                                       F.lit(False).alias("IsDelete"))
    load(rows(0, 50, "x"), "f1")
    assert store.current("t").buckets == 8 and store.current("t").text_bytes == 50
    load(rows(0, 20_000, "x"), "f2")                               # the numbers of the rows decide
    many = store.current("t")
    assert many.buckets >= 16 and many.rows == 20_000 and many.text_bytes == 20_000
    load(rows(20_000, 20_100, "y" * 100_000), "f3")                # and the lengths of their texts, however well packed
    long = store.current("t")
    assert long.buckets >= 128 and long.text_bytes == 20_000 + 100 * 100_000
    load(rows(0, 1, "zz"), "f4")                                   # the stored rows count, not those that come
    last = store.current("t")
    assert last.buckets == long.buckets and last.text_bytes == long.text_bytes + 1
    assert sorted(r["RECID"] for r in store.read("t").collect()) == list(range(20_100))


def test_merges_keep_one_file_per_bucket_and_join_once(spark, tmp_dir, monkeypatch):
    from tidemark.plans import ingest
    store, load = loader(spark, tmp_dir)
    rows = spark.range(4000).select(F.col("id").alias("RECID"), F.lit(0).alias("a"), F.lit(None).cast("boolean").alias("IsDelete"))
    load(rows, "f0")
    joins = []
    real = ingest.merge
    monkeypatch.setattr(ingest, "merge", lambda *a, **k: joins.append(1) or real(*a, **k))
    for k in range(1, 11):
        some = spark.range(k * 100, k * 100 + 300).select(
            F.when(F.col("id") % 150 != 0, F.col("id") + F.when(F.col("id") % 3 == 0, 10000).otherwise(0)).alias("RECID"),
            F.lit(k).alias("a"), (F.col("id") % 7 == 0).alias("IsDelete")).dropDuplicates(["RECID"])
        row = load(some, f"f{k:02d}")
        assert row["source_rows"] == row["inserted"] + row["updated"] + row["deleted"] + row["unchanged"] + row["ignored"]
        assert row["rows_after"] == store.read("t").count() == store.current("t").rows
        assert len(state_files(store)) <= 8 + 1
    assert len(joins) == 10 and store.current("t").seq == 11 and store.current("t").lastload == "f10"
    feed = {r["_run_id"] for r in store.changes("t").collect()}
    assert len(feed) == 11


def test_bucket_count_follows_the_table(spark, tmp_dir):
    store, load = loader(spark, tmp_dir, bucket_bytes=2000)
    rows = lambda a, b, v: spark.range(a, b).select(F.col("id").alias("RECID"), F.lit(v).alias("a"),
                                                    F.sha2(F.col("id").cast("string"), 256).alias("text"),
                                                    F.lit(False).alias("IsDelete"))
    load(rows(0, 50, 1), "f1")
    small = store.current("t").buckets
    load(rows(50, 2000, 1), "f2")
    load(rows(2000, 2010, 1), "f3")
    grown = store.current("t")
    assert small == 8 and grown.buckets > 32 and len(state_files(store)) <= grown.buckets + 1
    assert store.read("t").count() == 2010
    assert store.read("t").select("RECID").distinct().count() == 2010


def test_table_that_loses_all_rows(spark, tmp_dir):
    store, load = loader(spark, tmp_dir)
    ddl = "RECID BIGINT, a INT, IsDelete BOOLEAN"
    load(spark.createDataFrame([(1, 1, None), (None, 1, None)], ddl), "f1")
    row = load(spark.createDataFrame([(1, 2, True), (None, 2, True)], ddl), "f2")
    assert row["deleted"] == 2 and store.read("t").count() == 0
    load(spark.createDataFrame([(5, 3, None)], ddl), "f3")
    assert [r["RECID"] for r in store.read("t").collect()] == [5]
    assert sorted((r["RECID"] or 0, r["_change_type"]) for r in store.changes("t").collect()) == [
        (0, "delete"), (0, "insert"), (1, "delete"), (1, "insert"), (5, "insert")]


def test_types_that_do_not_fit_are_named_before_the_load(spark, tmp_dir):
    store, load = loader(spark, tmp_dir)
    load(spark.createDataFrame([(1, 1, 5, None)], "RECID BIGINT, a INT, code BIGINT, IsDelete BOOLEAN"), "f1")
    with pytest.raises(ValueError, match="code: string into bigint"):
        load(spark.createDataFrame([(1, 1, "label", None)], "RECID BIGINT, a INT, code STRING, IsDelete BOOLEAN"), "f2")
    assert store.watermark("t") == "f1"
    load(spark.createDataFrame([(1, 1, 7, None)], "RECID BIGINT, a INT, code INT, IsDelete BOOLEAN"), "f3")
    assert store.read("t").first()["code"] == 7


def test_two_stores_on_one_root_read_the_current_snapshot(spark, tmp_dir):
    from tidemark.sinks.store import TableStore
    a, load = loader(spark, tmp_dir)
    ddl = "RECID BIGINT, a INT, IsDelete BOOLEAN"
    load(spark.createDataFrame([(1, 1, None)], ddl), "f1")
    old = a.current("t")
    load(spark.createDataFrame([(2, 1, None)], ddl), "f2")
    b = TableStore(spark, tmp_dir)
    assert a.read("t").count() == 2
    assert b.read("t", old).count() == 1
    assert a.read("t").count() == 2 and b.read("t").count() == 2


def test_stamps_and_commit_order_in_any_clock_zone(spark, tmp_dir, monkeypatch):
    """Driver in New York across the change from winter to summer time: the later commit stays current."""
    import datetime as dt
    import time

    from tidemark.sinks import store as module
    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    try:
        store, load = loader(spark, tmp_dir)
        clock = iter([dt.datetime(2026, 3, 8, 2, 30, tzinfo=dt.timezone.utc), dt.datetime(2026, 3, 8, 3, 10, tzinfo=dt.timezone.utc),
                      dt.datetime(2026, 3, 8, 1, 0, tzinfo=dt.timezone.utc)])

        class Clock(dt.datetime):
            @classmethod
            def now(cls, tz=None):
                return next(clock)
        monkeypatch.setattr(module._dt, "datetime", Clock)
        for path in ("/p/1", "/p/2", "/p/3"):
            store.commit("c", path, path, "r", "merge", 1)
            assert store.current("c").path == path and store.current_all(["c"])["c"].path == path
        monkeypatch.undo()
        monkeypatch.setenv("TZ", "America/New_York")
        time.tzset()
        ddl = "RECID BIGINT, a INT, IsDelete BOOLEAN"
        begun = time.time()
        load(spark.createDataFrame([(1, 1, None)], ddl), "f1")
        load(spark.createDataFrame([(1, 2, None), (2, 1, None)], ddl), "f2")
        ended = time.time()
        stamps = store.read("t").selectExpr("cast(_sysCreatedDateTime as double) c", "cast(_sysProcessedDateTime as double) p").collect()
        assert all(begun - 1 <= r["c"] <= r["p"] <= ended + 1 for r in stamps)
    finally:
        monkeypatch.undo()
        time.tzset()


def test_composite_key_bucketed_target_is_not_exchanged(spark, tmp_dir):
    from test_latest import _shuffle_records
    from tidemark.session import stage_measured
    from tidemark.sinks.store import TableStore
    store = TableStore(spark, tmp_dir)
    t = spark.range(0, 4000).select((F.col("id") % 100).alias("k1"), (F.col("id") / 100).cast("bigint").alias("k2"),
                                    F.lit("x").alias("v"))
    path = store.write_snapshot("t", t.repartition(8, "k1", "k2"), "r1", "k1,k2", 8)
    store.commit("t", path, "f1", "r1", "replace", 4000, None, 8, "k1,k2")
    src = spark.createDataFrame([(1, 0, "y", None), (5, 999, "z", None), (2, 0, None, True)],
                                "k1 BIGINT, k2 BIGINT, v STRING, IsDelete BOOLEAN")
    staged = stage_measured(src, "test-src2")[0]
    res = merge(store.read("t"), staged, ["k1", "k2"], strategy="shuffle")
    out = res.state
    out.write.format("noop").mode("overwrite").save()
    assert _shuffle_records(out) <= 3
    got = {(r["k1"], r["k2"]): r["v"] for r in out.collect()}
    assert len(got) == 4000 and got[(1, 0)] == "y" and got[(5, 999)] == "z" and (2, 0) not in got


def _stored_rows(spark, tmp_dir, n=4000, buckets=32, **options):
    from tidemark.config import LandingConfig
    from tidemark.plans.ingest import apply_changes
    from tidemark.sinks.store import TableStore
    cfg = LandingConfig("", f"{tmp_dir}/s", buckets=buckets, **options)
    store = TableStore(spark, cfg.store_root)
    rows = spark.range(n).selectExpr("id as RECID", "id % 7 as a", "cast(id as string) as b", "false as IsDelete", "1L as SinkModifiedOn")

    def load(changes, folder):
        return apply_changes(spark, cfg, store, "t", spark.createDataFrame(changes, S_DDL) if isinstance(changes, list) else changes,
                             folder, folder)

    load(rows, "f1")
    return store, load, {k: (k % 7, str(k)) for k in range(n)}


def _state(store):
    return {r["RECID"]: (r["a"], r["b"]) for r in store.read("t").collect()}


def test_small_change_sets_read_and_write_their_buckets_only(spark, tmp_dir):
    import os
    store, load, want = _stored_rows(spark, tmp_dir)
    first = store.current("t")
    row = load([(5, 1, "new", False, 2), (6, 0, "x", True, 2), (9_000, 3, "in", False, 2), (9_001, 3, "in", True, 2)], "f2")
    assert row["strategy"] == "touched" and (row["inserted"], row["updated"], row["deleted"], row["ignored"]) == (1, 1, 1, 1)
    want |= {5: (1, "new"), 9_000: (3, "in")}
    del want[6]
    snap = store.current("t")
    assert row["rows_after"] == snap.rows == len(want) and _state(store) == want
    # Written: the changes' buckets; the others' files are those of the first load, which the merge didn't read.
    import json
    new, old = json.loads(snap.layers)
    assert 1 <= len(new["buckets"]) <= 4 and old == {"path": first.path, "buckets": None}
    files = [p for p, _ in store.bucket_files(snap)]
    assert len(files) == 32 and sum(first.path in p for p in files) == 32 - len(new["buckets"])
    read = store.read_buckets(first, set(new["buckets"])).inputFiles()
    assert len(read) == len(new["buckets"]) and all(os.path.basename(f).split("_")[-1][:5].isdigit() for f in read)

    # A second small load goes over the first one's layer, a large one writes all again.
    assert load([(5, 1, "newer", False, 3), (77, 0, "y", False, 3)], "f3")["strategy"] == "touched"
    want |= {5: (1, "newer"), 77: (0, "y")}
    assert _state(store) == want and len(json.loads(store.current("t").layers)) == 3
    assert load([(k, 6, "all", False, 4) for k in range(300)], "f4")["strategy"] == "shuffle"
    want |= {k: (6, "all") for k in range(300)}
    assert _state(store) == want and store.current("t").layers is None and store.current("t").buckets == 32
    assert len(store.bucket_files(store.current("t"))) == 32


def test_touched_buckets_with_null_keys_deletes_and_new_columns(spark, tmp_dir):
    store, load, want = _stored_rows(spark, tmp_dir, n=40, buckets=16, max_layers=3)
    strategies = []
    for k, (changes, effect) in enumerate([
            ([(None, 1, "null", False, 2)], {None: (1, "null")}), ([(None, 2, "null", False, 3)], {None: (2, "null")}),
            ([(None, 2, "null", True, 4)], {None: None}), ([(3, 3, "3", True, 5)], {3: None}), ([(3, 1, "back", False, 6)], {3: (1, "back")})]):
        strategies.append(load(changes, f"g{k}")["strategy"])
        want |= effect
        assert _state(store) == {k: v for k, v in want.items() if v is not None}
    assert strategies == ["touched", "touched", "shuffle", "touched", "touched"]      # three layers are the most
    more = spark.createDataFrame([(4, 1, "4", False, 9, "c")], S_DDL + ", extra STRING")
    assert load(more, "h")["strategy"] == "shuffle"
    got = store.read("t").where("RECID in (4, 5)").select("RECID", "extra").collect()
    assert sorted(map(tuple, got)) == [(4, "c"), (5, None)]


def test_net_changes_lead_from_one_state_to_another(spark, tmp_dir):
    store, load, _ = _stored_rows(spark, tmp_dir, n=30, buckets=8)
    states = [_state(store)]
    rng = random.Random(12)
    for k in range(4):
        keys = rng.sample([*range(36), None], 12)
        load([(key, rng.randrange(4), rng.choice("xyz"), rng.random() < 0.4, 10 + k) for key in keys], f"n{k}")
        states.append(_state(store))
    for after in range(1, 5):
        for upto in range(after, 6):
            net = store.net_changes("t", ["RECID"], after, upto).collect()
            kinds = {}
            for r in net:
                kinds.setdefault(r["RECID"], {})[r["_change_type"]] = (r["a"], r["b"])
            state = dict(states[after - 1])
            for key, kind in kinds.items():
                assert set(kind) in ({"insert"}, {"delete"}, {"update_preimage", "update_postimage"})
                assert kind.get("delete", kind.get("update_preimage")) == state.pop(key, None)
                if "delete" not in kind:
                    state[key] = kind.get("insert", kind.get("update_postimage"))
            assert state == states[upto - 1]
    store.replace("t", store.read("t").limit(1))
    with pytest.raises(ValueError, match="reloaded"):
        store.net_changes("t", ["RECID"], 2)
