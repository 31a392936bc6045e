"""Write landing trees in the export format (model document, changelog,
entity CSV folders, enum metadata).  Used to build fixtures from the given
tables and by jobs that re-export; every writer is a Spark writer, so paths
may be on any shared file system."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemark.config import CHANGELOG_FILE, ENUM_FILE, MODEL_FILE
from tidemark.sources.csvscan import write_entity_csv


def model_document(entities: dict[str, Sequence[tuple[str, str]]]) -> str:
    """JSON text of a model: ``{entity: [(attribute, dataType), ...]}``."""
    return json.dumps({"entities": [
        {"name": name, "attributes": [{"name": a, "dataType": t} for a, t in attrs]}
        for name, attrs in entities.items()]}, indent=2)


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    spark.createDataFrame([(text,)], "value STRING").coalesce(1).write.mode("overwrite").text(path)


def write_model(spark: SparkSession, root: str, entities: dict[str, Sequence[tuple[str, str]]]) -> str:
    path = f"{root.rstrip('/')}/{MODEL_FILE}"
    _write_text(spark, path, model_document(entities))
    return path


def write_changelog(spark: SparkSession, root: str, text: str) -> str:
    path = f"{root.rstrip('/')}/{CHANGELOG_FILE}"
    _write_text(spark, path, text)
    return path


def write_folder(df: DataFrame, root: str, folder: str, table: str, files: int | None = None) -> str:
    """Rows of one table into ``<root>/<folder>/<table>/`` as export CSV."""
    path = f"{root.rstrip('/')}/{folder}/{table}"
    write_entity_csv(df, path, files)
    return path


def write_enums(df: DataFrame, root: str, folder: str) -> str:
    """Enum metadata rows (eight columns, fixed order) into ``<folder>``."""
    path = f"{root.rstrip('/')}/{folder}/{ENUM_FILE}"
    write_entity_csv(df, path, 1)
    return path
