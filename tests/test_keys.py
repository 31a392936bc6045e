from pyspark.sql import functions as F

from tidemark.functions.keys import (guid_from_ids, record_id_from_guid, repair_keys,
                                     table_id_from_guid)


def test_record_and_table_id_from_known_guid(spark):
    df = spark.createDataFrame([("00000077-0000-0000-d204-005001000000",)], "g STRING")
    r = df.select(record_id_from_guid(F.col("g")).alias("r"), table_id_from_guid(F.col("g")).alias("t")).first()
    assert r["r"] == 5637145810
    assert r["t"] == 119


def test_bad_guids_give_null(spark):
    rows = [("00000077-0000-0000-ffff-ffffffffffff",),   # top bit set: above bigint
            ("zzzzzzzz-0000-0000-d204-00500100zzzz",),   # not hex
            (None,), ("short",)]
    out = spark.createDataFrame(rows, "g STRING").select(
        record_id_from_guid(F.col("g")).alias("r"), table_id_from_guid(F.col("g")).alias("t")).collect()
    assert [r["r"] for r in out] == [None, None, None, None]
    assert [r["t"] for r in out] == [119, None, None, None]


def test_guid_round_trip(spark):
    df = spark.range(0, 2000).select(F.col("id").alias("k"), (F.col("id") * 7919 + 3).alias("t"))
    g = df.select("k", "t", guid_from_ids(F.col("t"), F.col("k")).alias("g"))
    back = g.select("k", "t", record_id_from_guid(F.col("g")).alias("k2"), table_id_from_guid(F.col("g")).alias("t2"))
    assert back.filter((F.col("k") != F.col("k2")) | (F.col("t") != F.col("t2"))).count() == 0
    assert g.first()["g"] == "00000003-0000-0000-0000-000000000000"


def test_repair_only_where_null(spark):
    g = "00000077-0000-0000-d204-005001000000"
    df = spark.createDataFrame([(g, None, None), (g, 5, 6)], "sl_id STRING, tableid BIGINT, recid BIGINT")
    out = repair_keys(df).orderBy(F.col("tableid")).collect()
    assert (out[0]["tableid"], out[0]["recid"]) == (5, 6)
    assert (out[1]["tableid"], out[1]["recid"]) == (119, 5637145810)
