import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators.latest import latest_change, latest_version

DDL = "RECID BIGINT, VersionNumber BIGINT, SinkModifiedOn TIMESTAMP, RecVersion BIGINT, IsDelete BOOLEAN, v STRING"
T = dt.datetime(2024, 1, 1)


def test_version_order_nulls_last_and_deletes_ranked(spark):
    rows = [(1, 1, T, 1, False, "old"), (1, 3, T, 1, False, "new"), (1, 2, T, 9, False, "mid"),
            (2, None, T, 1, False, "nullver"), (2, 1, T, 1, False, "v1"),
            (3, 1, T, 1, False, "live"), (3, 2, T, 1, True, "deleted-latest"),
            (4, 2, T, 1, False, "live-latest"), (4, 1, T, 1, True, "deleted-older"),
            (5, 1, T, 1, False, "a"), (5, 1, T + dt.timedelta(seconds=1), 1, False, "b"),
            (None, 1, T, 1, False, "n1"), (None, 2, T, 1, False, "n2")]
    out = {r["RECID"]: r["v"] for r in latest_change(spark.createDataFrame(rows, DDL), ["RECID"]).collect()}
    assert out == {1: "new", 2: "v1", 3: "deleted-latest", 4: "live-latest", 5: "b", None: "n2"}


def test_case_insensitive_names_and_total_tiebreak(spark):
    rows = [(1, 1, T, 1, False, "x"), (1, 1, T, 1, False, "y")]
    df = spark.createDataFrame(rows, DDL)
    a = latest_change(df, ["recid"]).collect()
    b = latest_change(df.repartition(3), ["recid"]).collect()
    assert a[0]["v"] == b[0]["v"] == "y"


def test_partial_top1_before_shuffle(spark):
    df = spark.range(0, 1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = latest_version(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def _shuffle_records(df):
    """Records written by the exchanges of an executed adaptive plan."""
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.finalPhysicalPlan() if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else plan
    total, todo = 0, [plan]
    while todo:
        p = todo.pop()
        if p.getClass().getSimpleName() == "ShuffleQueryStageExec":
            p = p.plan()
        if "Exchange" in p.getClass().getSimpleName() and p.metrics().contains("shuffleRecordsWritten"):
            total += p.metrics().apply("shuffleRecordsWritten").value()
        it = p.children().iterator()
        while it.hasNext():
            todo.append(it.next())
    return total


def test_hot_key_crosses_the_shuffle_once_per_map_task(spark):
    """One key holds a third of the rows: each map task forwards one row of it."""
    n, parts = 30000, 6
    df = spark.range(0, n, 1, parts).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    out = latest_version(df, ["k"], ["v"])
    out.write.format("noop").mode("overwrite").save()
    assert _shuffle_records(out) == 2 * n // 3 + parts
    assert out.filter(F.col("k") == 0).first()["v"] == n - 3
