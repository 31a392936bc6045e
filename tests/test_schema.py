import json
import random

import pytest
from pyspark.sql.types import DecimalType, LongType, StringType, TimestampType

from tidemark.config import RENAME_COLUMNS
from tidemark.sources.model import entity_schema, model_attributes, read_model, schema_catalog


def rule(names):
    """Plain-Python statement of the naming rule (dedup suffix, then rename)."""
    acc = []
    for n in names:
        name = n
        if any(a.lower() == n.lower() for a in acc):
            k = 1
            while any(a.lower() == f"{n}{k}".lower() for a in acc):
                k += 1
            name = f"{n}{k}"
        acc.append(RENAME_COLUMNS.get(name, name))
    return acc


def catalog_names(spark, lists):
    rows = [(f"e{i}", j, n, "string") for i, names in enumerate(lists) for j, n in enumerate(names)]
    df = spark.createDataFrame(rows, "entity STRING, ordinal INT, name STRING, data_type STRING")
    got = {}
    for r in schema_catalog(df).collect():
        got.setdefault(r["entity"], {})[r["ordinal"]] = r["column_name"]
    return [[got[f"e{i}"][j] for j in range(len(names))] for i, names in enumerate(lists)]


def test_dedup_rule_matches_python_on_random_lists(spark):
    rnd = random.Random(7)
    pool = ["a", "A", "a1", "A1", "a11", "a2", "Id", "id", "fno_id", "sl_id", "ID1", "b", "B1"]
    lists = [[rnd.choice(pool) for _ in range(rnd.randint(1, 12))] for _ in range(300)]
    assert catalog_names(spark, lists) == [rule(x) for x in lists]


def test_examples(spark):
    assert catalog_names(spark, [["a", "A", "a1"]]) == [["a", "A1", "a11"]]
    assert catalog_names(spark, [["Id", "id", "fno_id"]]) == [["sl_id", "id", "id"]]


MODEL = {"entities": [
    {"name": "custtable", "attributes": [
        {"name": "Id", "dataType": "guid"}, {"name": "SinkCreatedOn", "dataType": "DateTime"},
        {"name": "SinkModifiedOn", "dataType": "datetime"}, {"name": "createdon", "dataType": "datetimeoffset"},
        {"name": "recid", "dataType": "int64"}, {"name": "amount", "dataType": "decimal"},
        {"name": "weird", "dataType": "money"}, {"name": "fno_id", "dataType": "string"}]},
    {"name": "dup", "attributes": [{"name": "Id", "dataType": "guid"}, {"name": "id", "dataType": "string"},
                                   {"name": "fno_id", "dataType": "string"}]}]}


@pytest.mark.parametrize("indent", [None, 2])
def test_model_file_pretty_or_one_line(spark, tmp_dir, indent):
    path = f"{tmp_dir}/model.json"
    with open(path, "w") as f:
        json.dump(MODEL, f, indent=indent)
    cat = schema_catalog(model_attributes(read_model(spark, path)))
    st = entity_schema(cat, "custtable")
    assert [f.name for f in st.fields] == ["sl_id", "SinkCreatedOn", "SinkModifiedOn", "createdon", "recid",
                                           "amount", "weird", "id"]
    types = {f.name: f.dataType for f in st.fields}
    assert types["SinkCreatedOn"] == StringType()         # type names compare case-insensitively
    assert types["SinkModifiedOn"] == StringType()
    assert types["createdon"] == TimestampType()
    assert types["recid"] == LongType()
    assert types["amount"] == DecimalType(38, 6)
    assert types["weird"] == StringType()
    with pytest.raises(ValueError, match="collide"):
        entity_schema(cat, "dup")
    with pytest.raises(ValueError, match="not in the model"):
        entity_schema(cat, "absent")
