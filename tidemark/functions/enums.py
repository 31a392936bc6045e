"""Enum decoding (operators F1, F2, J5, J7, D2, H1).

Integer enum columns are replaced by their labels from the enum metadata
table.  A code not listed decodes to NULL.  When one code has several labels
(e.g. one per language) the smallest label is used, so the result does not
depend on row order.  Attributes listed in the metadata but absent from the
table are skipped.

Labels of attributes with few codes are literals of one projection; an
attribute with more codes than the limit is a left join against the
de-duplicated lookup.  No per-row Python.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import find_column


def enum_lookup(enums: DataFrame, entity: str | None = None) -> DataFrame:
    """``entity, attribute, code, label``: one label per (entity, attribute, code)."""
    e = enums if entity is None else enums.filter(F.col("EntityName") == entity)
    return (e.filter(F.col("OptionName").isNotNull())
            .groupBy(F.col("EntityName").alias("entity"), F.col("OptionSetName").alias("attribute"),
                     F.col("Option").alias("code"))
            .agg(F.min("OptionName").alias("label")))


def decode_enums(df: DataFrame, enums: DataFrame, entity: str, inline_codes: int = 1_000) -> DataFrame:
    """Replace each enum column of ``entity`` by its label (type string).

    The attributes' codes are counted first; the labels of attributes with at most ``inline_codes``
    codes are then collected, and all their columns decoded in one projection.  Larger attributes are joined.
    """
    lookup = enum_lookup(enums, entity)
    own = enums.filter((F.col("EntityName") == entity) & F.col("OptionName").isNotNull())
    # Counted by (attribute, code) first: however many codes an attribute has, no task gets them all.
    counts = own.groupBy(F.col("OptionSetName").alias("attribute")).agg(F.count_distinct("Option").alias("codes")).collect()
    columns = {r["attribute"]: (find_column(df, r["attribute"]), r["codes"] <= inline_codes) for r in counts}
    columns = {a: c for a, c in columns.items() if c[0] is not None}
    small = [a for a, (_, inline) in columns.items() if inline]
    labels = {a: {} for a in small}
    if small:
        for r in lookup.filter(F.col("attribute").isin(small) & F.col("code").isNotNull()).collect():
            labels[r["attribute"]][r["code"]] = r["label"]
    decoded = {}
    for attribute, found in labels.items():
        name, pairs = columns[attribute][0], [F.lit(x) for p in sorted(found.items()) for x in p]
        decoded[name] = (F.try_element_at(F.create_map(*pairs), F.col(name).cast("bigint")) if pairs
                         else F.lit(None).cast("string"))
    out = df.withColumns(decoded) if decoded else df
    for i, (attribute, (name, inline)) in enumerate(sorted(columns.items())):
        if not inline:
            code, label = f"__enum_code_{i}", f"__enum_label_{i}"
            side = lookup.filter(F.col("attribute") == attribute).select(
                F.col("code").alias(code), F.col("label").alias(label))
            joined = out.join(side, F.col(name) == F.col(code), "left")
            out = joined.select(*[F.col(label).alias(c) if c == name else F.col(c) for c in out.columns])
    return out


def enum_case_text(enums: DataFrame, entity: str | None = None) -> DataFrame:
    """Per (entity, attribute) the ordered decode rule as text,
    ``when <code> then '<label>' ...`` (labels quoted SQL-style)."""
    lookup = enum_lookup(enums, entity)
    piece = F.struct("code", F.concat(F.lit("when "), F.col("code").cast("string"), F.lit(" then '"),
                                      F.regexp_replace("label", "'", "''"), F.lit("'")).alias("t"))
    return (lookup.groupBy("entity", "attribute")
            .agg(F.sort_array(F.collect_list(piece)).alias("p"))
            .select("entity", "attribute",
                    F.array_join(F.expr("transform(p, x -> x.t)"), " ").alias("case_text")))
