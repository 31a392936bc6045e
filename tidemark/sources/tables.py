"""Config tables and table selection (operators A6, A12, M4)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_config(spark: SparkSession, source: str, fmt: str = "parquet", **options) -> DataFrame:
    """The table list from any Spark source (``fmt='table'`` for a
    catalog table, ``'jdbc'`` with ``url``/``query`` options, files otherwise)."""
    if fmt == "table":
        return spark.table(source)
    reader = spark.read.format(fmt).options(**options)
    return reader.load() if fmt == "jdbc" else reader.load(source)


def _names(table_names: str | Iterable[str] | None) -> list[str]:
    if table_names is None:
        return []
    if isinstance(table_names, str):
        return [t.strip() for t in table_names.split(",") if t.strip()]
    return [t for t in table_names if t]


def select_tables(config: DataFrame, processing_group: str | None = None,
                  table_names: str | Iterable[str] | None = None) -> DataFrame:
    """M4: rows of the given processing group and/or the explicit table list
    (comma-separated string or iterable).  With neither, every row."""
    names = _names(table_names)
    cond = None
    if processing_group:
        cond = F.col("processing_group") == processing_group
    if names:
        c = F.col("table_name").isin(*names)
        cond = c if cond is None else (cond | c)
    return config if cond is None else config.filter(cond)
