from test_ingest import F1, F2, F3, changelog, landing, line, write

from tidemark.config import LandingConfig
from tidemark.plans.ingest import ingest_table, load_enums
from tidemark.sinks.store import TableStore
from tidemark.streaming import load_batch, stream_table


def test_available_now_stream_equals_batch(spark, tmp_dir):
    root = f"{tmp_dir}/landing"
    landing(root)
    changelog(root, F3)
    batch_cfg = LandingConfig(landing_root=root, store_root=f"{tmp_dir}/batch")
    stream_cfg = LandingConfig(landing_root=root, store_root=f"{tmp_dir}/stream")
    for cfg in (batch_cfg, stream_cfg):
        load_enums(spark, cfg)
    changelog(root, "2024-01-09T00.00.00Z")           # every folder closed for the batch job
    ingest_table(spark, batch_cfg, "custtable")
    q = stream_table(spark, stream_cfg, "custtable")
    q.awaitTermination(300)
    batch = sorted((r["recid"], r["accountnum"], r["blocked"]) for r in TableStore(spark, batch_cfg.store_root).read("custtable").collect())
    stream_store = TableStore(spark, stream_cfg.store_root)
    assert sorted((r["recid"], r["accountnum"], r["blocked"]) for r in stream_store.read("custtable").collect()) == batch

    # a new folder: the next run reads only its file
    write(f"{root}/2024-01-04T00.00.00Z/custtable/p.csv", [line(107, 1, "G1")])
    q = stream_table(spark, stream_cfg, "custtable")
    q.awaitTermination(300)
    last = stream_store.current("custtable")
    assert last.lastload == "2024-01-04T00.00.00Z"
    got = {r["recid"] for r in stream_store.read("custtable").collect()}
    assert got == {b[0] for b in batch} | {107}


def test_open_folder_is_no_part_of_the_stream(spark, tmp_dir):
    root = f"{tmp_dir}/landing"
    landing(root)
    changelog(root, F2)                                # F1 is closed, F2 is being written
    cfg = LandingConfig(landing_root=root, store_root=f"{tmp_dir}/s")
    load_enums(spark, cfg)
    store = TableStore(spark, cfg.store_root)
    stream_table(spark, cfg, "custtable").awaitTermination(300)
    assert store.current("custtable").lastload == F1
    before = store.current("custtable")
    stream_table(spark, cfg, "custtable").awaitTermination(300)     # nothing new
    assert store.current("custtable").seq == before.seq
    changelog(root, F3)
    stream_table(spark, cfg, "custtable").awaitTermination(300)
    assert store.current("custtable").lastload == F2


def test_replayed_batch_is_loaded_once(spark, tmp_dir):
    """The stream's own commit of a batch is lost: the batch runs again and changes nothing."""
    import os
    root = f"{tmp_dir}/landing"
    landing(root)
    changelog(root, F3)
    cfg = LandingConfig(landing_root=root, store_root=f"{tmp_dir}/s")
    load_enums(spark, cfg)
    store = TableStore(spark, cfg.store_root)
    checkpoint = f"{tmp_dir}/checkpoint"
    stream_table(spark, cfg, "custtable", checkpoint).awaitTermination(300)
    first = store.current("custtable")
    changes = store.changes("custtable").count()
    [commit] = [f for f in os.listdir(f"{checkpoint}/commits") if f.isdigit()]
    for name in (commit, f".{commit}.crc"):
        os.remove(f"{checkpoint}/commits/{name}")
    q = stream_table(spark, cfg, "custtable", checkpoint)
    q.awaitTermination(300)
    assert q.exception() is None and os.path.exists(f"{checkpoint}/commits/{commit}")  # the batch did run again
    assert store.current("custtable") == first and store.changes("custtable").count() == changes
    names = {F1, F2}
    assert load_batch(spark, cfg, store, "custtable", names, "another stream/0") is None    # not past the mark either
