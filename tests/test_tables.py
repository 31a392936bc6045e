from tidemark.sources.tables import read_config, select_tables


def test_config_sources_and_selection(spark, tmp_dir):
    rows = [("custtable", "pg_daily"), ("custgroup", "pg_daily"), ("dirpartytable", "pg_weekly")]
    df = spark.createDataFrame(rows, "table_name STRING, processing_group STRING")
    df.write.parquet(f"{tmp_dir}/cfg")
    df.createOrReplaceTempView("cfg_view")
    for cfg in (read_config(spark, f"{tmp_dir}/cfg"), read_config(spark, "cfg_view", fmt="table")):
        names = lambda d: sorted(r["table_name"] for r in d.collect())
        assert names(select_tables(cfg)) == ["custgroup", "custtable", "dirpartytable"]
        assert names(select_tables(cfg, "pg_daily")) == ["custgroup", "custtable"]
        assert names(select_tables(cfg, table_names="dirpartytable, custtable")) == ["custtable", "dirpartytable"]
        assert names(select_tables(cfg, "pg_weekly", ["custgroup"])) == ["custgroup", "dirpartytable"]
        assert names(select_tables(cfg, table_names="")) == ["custgroup", "custtable", "dirpartytable"]


def test_scratch_folders_can_be_removed(spark):
    import glob

    from tidemark.session import clear_scratch, ensure_checkpoint_dir, local_path, stage
    assert stage(spark.range(3), "test-clear").count() == 3
    pattern = f"{local_path(ensure_checkpoint_dir(spark))}/tidemark-test-clear-*"
    assert glob.glob(pattern)
    clear_scratch(spark)
    assert not glob.glob(pattern)
