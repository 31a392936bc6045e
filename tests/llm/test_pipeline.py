"""The corpus pipeline: stages in order, each with what its predecessor kept."""
import corpus_pipeline as cp
from tidemark.llm.common import stage

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert [n for n, _ in cp.STAGES] == ["toxicity", "simhash_near_dedup", "substring_dedup", "best_fit_packing"]
    kept = docs
    for name, step in cp.STAGES[:-1]:
        before = kept
        kept = stage(step(spark, before, FOLDER), "test")
        assert kept.columns == docs.columns
        ids = {r.doc_id for r in kept.select("doc_id").collect()}
        assert ids <= {r.doc_id for r in before.select("doc_id").collect()} and ids
        if name == "substring_dedup":
            assert len(ids) == before.count()
    packed = cp.STAGES[-1][1](spark, kept, FOLDER).collect()
    assert {r.doc_id for r in packed} == ids
    assert len(cp.run(spark, FOLDER).collect()) == len(packed)


#: Names that the stages use for columns of their own.
INTERNAL = ("fp", "th", "root", "key", "row", "k_id", "k_th", "__kept_words", "kept", "new", "changed_key", "chosen_key", "sha", "copy",
            "first", "n_words", "n_removed", "kept_sha256", "ranges", "start", "windows", "anchor", "run", "recurring", "anchors", "y",
            "features", "rank", "score", "piece", "length", "ids_crc32", "sequence_id", "offset", "bucket", "gives", "component_id",
            "node", "u", "v", "w", "n", "i", "a", "b", "k", "r", "none", "KEY", "Row")


def test_stages_take_every_name_of_their_own(spark):
    from pyspark.sql import functions as F
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(40)
    own = [n for n in INTERNAL if n not in ("KEY", "Row")]
    odd = docs.select("*", *[F.lit(n).alias(n) for n in own])
    upper = docs.select("*", F.lit(1).alias("KEY"), F.lit(2).alias("Row"))
    for kept in (odd, upper):
        for _, step in cp.STAGES[:-1]:
            before, kept = kept, stage(step(spark, kept, FOLDER), "test")
            assert kept.columns == before.columns
        assert kept.count() > 20 and kept.drop(*docs.columns).distinct().count() == 1
        assert cp.STAGES[-1][1](spark, kept, FOLDER).select("doc_id").distinct().count() == kept.count()


def test_stages_take_nulls_extra_columns_and_no_rows(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(60)
    odd = docs.selectExpr("*", "'a' as fp", "1 as th", "2 as root").unionByName(spark.createDataFrame(
        [(None, None, None, None, None, "b", 1, 1), (None, "text without id", None, "s", 3, "b", 1, 1), (900, "", "en", None, 0, "c", 1, 1)],
        "doc_id long, text string, lang string, source string, n_chars long, fp string, th int, root int"))
    for part in (odd, odd.limit(0)):
        kept = part
        for _, step in cp.STAGES[:-1]:
            kept = step(spark, kept, FOLDER)
            assert kept.columns == odd.columns
            kept = stage(kept, "test")
        assert kept.count() <= part.count()
        assert cp.STAGES[-1][1](spark, kept, FOLDER).select("doc_id").distinct().count() == kept.select("doc_id").distinct().count()
    texts = {r.text for r in kept.collect()}
    assert not texts
