"""Model document -> schema catalog (operators A3, C1-C4, D1).

``model.json`` lists entities with ordered ``attributes {name, dataType}``.
The catalog has one row per (entity, ordinal) with the final column name
and Spark type:

* C2  a name equal (ignoring case) to an earlier accepted name gets the
      smallest integer suffix that makes it unique;
* C1  then ``Id`` -> ``sl_id`` and ``fno_id`` -> ``id`` (exact case); the
      accepted list carries renamed names, the renamed name is not rechecked;
* C3  the type name maps to a Spark type (unknown names -> string).

The suffix rule is sequential within an entity, so it is one higher-order
``aggregate`` fold over that entity's attribute array; entities are
independent rows, so the catalog of many entities runs in parallel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from tidemark.config import RENAME_COLUMNS, SINK_TIMESTAMP_COLUMNS

MODEL_DDL = ("entities ARRAY<STRUCT<name: STRING, "
             "attributes: ARRAY<STRUCT<name: STRING, dataType: STRING>>>>")

# Model type names -> Spark types (case-insensitive).
TYPE_MAP = (
    (("datetime", "datetimeoffset"), "timestamp"),
    (("date",), "date"),
    (("boolean",), "boolean"),
    (("int16", "int32"), "int"),
    (("int64",), "bigint"),
    (("float",), "float"),
    (("double",), "double"),
    (("decimal",), "decimal(38,6)"),
    (("string", "guid"), "string"),
)


def read_model(spark: SparkSession, path: str) -> DataFrame:
    """A3: the model document; pretty-printed or one-line JSON both read."""
    return spark.read.schema(MODEL_DDL).option("multiLine", "true").json(path)


def model_attributes(model: DataFrame) -> DataFrame:
    """``entity, ordinal, name, data_type`` (ordinal from 0, in file order)."""
    ent = model.select(F.explode("entities").alias("e"))
    return ent.select(F.col("e.name").alias("entity"),
                      F.posexplode("e.attributes").alias("ordinal", "a")).select(
        "entity", "ordinal", F.col("a.name").alias("name"), F.col("a.dataType").alias("data_type"))


def _sql_str(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _rename_sql(x: str) -> str:
    branches = " ".join(f"WHEN {x} = {_sql_str(a)} THEN {_sql_str(b)}" for a, b in RENAME_COLUMNS.items())
    return f"CASE {branches} ELSE {x} END"


_PICK = ("CASE WHEN n IS NULL OR NOT exists(acc, a -> lower(a) = lower(n)) THEN n "
         "ELSE concat(n, CAST(element_at(filter(sequence(1, size(acc) + 1), "
         "k -> NOT exists(acc, a -> lower(a) = lower(concat(n, CAST(k AS STRING))))), 1) AS STRING)) END")

DEDUP_RENAME_SQL = (
    "aggregate(names, CAST(array() AS ARRAY<STRING>), (acc, n) -> "
    f"concat(acc, transform(array({_PICK}), p -> {_rename_sql('p')})))")


def spark_type_sql(name_col: str, type_col: str) -> str:
    t = f"lower({type_col})"
    sink = ", ".join(_sql_str(c) for c in SINK_TIMESTAMP_COLUMNS)
    branches = [f"WHEN {name_col} IN ({sink}) AND {t} = 'datetime' THEN 'string'"]
    for names, spark_type in TYPE_MAP:
        branches.append(f"WHEN {t} IN ({', '.join(_sql_str(n) for n in names)}) THEN '{spark_type}'")
    return "CASE " + " ".join(branches) + " ELSE 'string' END"


def schema_catalog(attributes: DataFrame) -> DataFrame:
    """C2-C4 over ``entity, ordinal, name, data_type`` rows.

    Output: ``entity, ordinal, source_name, column_name, data_type,
    spark_type, known_type, duplicate`` (``duplicate``: the final name occurs
    more than once in the entity, ignoring case).
    """
    per_entity = (attributes.groupBy("entity")
                  .agg(F.sort_array(F.collect_list(F.struct("ordinal", "name", "data_type"))).alias("attrs"))
                  .withColumn("names", F.expr("transform(attrs, a -> a.name)"))
                  .withColumn("final", F.expr(DEDUP_RENAME_SQL)))
    rows = per_entity.select("entity", F.posexplode(F.arrays_zip("attrs", "final")).alias("i", "z"))
    known = [n for names, _ in TYPE_MAP for n in names]
    out = rows.select(
        "entity",
        F.col("z.attrs.ordinal").alias("ordinal"),
        F.col("z.attrs.name").alias("source_name"),
        F.col("z.final").alias("column_name"),
        F.col("z.attrs.data_type").alias("data_type"))
    out = out.withColumn("spark_type", F.expr(spark_type_sql("column_name", "data_type")))
    out = out.withColumn("known_type", F.lower("data_type").isin(*known))
    dup = F.count(F.lit(1)).over(Window.partitionBy("entity", F.lower("column_name")))
    return out.withColumn("duplicate", dup > 1)


def _to_struct(entity: str, rows, allow_duplicates: bool) -> StructType:
    if not rows:
        raise ValueError(f"entity {entity!r} is not in the model")
    rows = sorted(rows, key=lambda r: r["ordinal"])
    dups = sorted({r["column_name"] for r in rows if r["duplicate"]})
    if dups and not allow_duplicates:
        raise ValueError(f"entity {entity!r}: renamed attributes collide: {dups}")
    return StructType([StructField(r["column_name"], _parse_datatype_string(r["spark_type"]), True)
                       for r in rows])


def entity_schema(catalog: DataFrame, entity: str, allow_duplicates: bool = False) -> StructType:
    """The StructType of one entity (D1: exact-case name match).

    Collects one entity's catalog rows, which are bounded by its attribute
    count.  Raises if the entity is absent or (T9) a name repeats.
    """
    rows = (catalog.filter(F.col("entity") == entity)
            .select("ordinal", "column_name", "spark_type", "duplicate").collect())
    return _to_struct(entity, rows, allow_duplicates)


def entity_schemas(catalog: DataFrame, entities, allow_duplicates: bool = False) -> dict:
    """``{entity: StructType or the ValueError it raises}`` for several
    entities from one job (rows bounded by their attribute counts)."""
    return entity_schemas_and_unknown(catalog, entities, allow_duplicates)[0]


def entity_schemas_and_unknown(catalog: DataFrame, entities, allow_duplicates: bool = False) -> tuple[dict, dict]:
    """``entity_schemas``, and ``{entity: ["attribute: type", ...]}`` of the type names not
    recognised (read as string), from the same job."""
    entities = list(entities)
    rows = (catalog.filter(F.col("entity").isin(*entities))
            .select("entity", "ordinal", "source_name", "column_name", "data_type", "spark_type", "known_type",
                    "duplicate").collect())
    out, unknown = {}, {}
    for e in entities:
        own = [r for r in rows if r["entity"] == e]
        try:
            out[e] = _to_struct(e, own, allow_duplicates)
        except ValueError as err:
            out[e] = err
        if odd := sorted(f"{r['source_name']}: {r['data_type']}" for r in own if not r["known_type"]):
            unknown[e] = odd
    return out, unknown


def unknown_types(catalog: DataFrame) -> DataFrame:
    """Attributes whose type name is not recognised (read as string)."""
    return catalog.filter(~F.col("known_type")).select("entity", "source_name", "data_type")
