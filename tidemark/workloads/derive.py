"""Change rows and entity tables derived from the given test tables.

The test tables stand in for the exporter's entities:

* ``lineitem`` is a change log: record id = ``l_orderkey * 10 + l_linenumber``
  (line numbers are below 10), version = ship year (NULL for open lines),
  sink-modified time = ship date, row version = supplier key, and the return
  flag marks deletes (``R``), live rows (``A``) or leaves the flag NULL (``N``).
  Changes shipped before ``CUTOFF`` form the first load; the rest, and some
  of the first sent again unchanged, the second.
* ``orders`` feeds the landing-tree load; ``customer``/``nation`` the enum and
  silver views; ``events`` the folder planning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed parameters of the derived scenarios.
CUTOFF = "1998-06-01 00:00:00"
RESENT = 25
COMPANY = "dat"
FOLDER_FORMAT = "yyyy-MM-dd'T'HH.mm.ss'Z'"
FIRST_MARK = "2024-01-05T00.00.00Z"

PAYLOAD = ("l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
           "l_returnflag", "l_linestatus")
CHANGE_KEY = ("recid",)
CHANGE_ORDER = ("versionnumber", "SinkModifiedOn", "recversion")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lineitem_changes(li: DataFrame, null_key: Column | None = None) -> DataFrame:
    """Change rows of the lineitem log (see module doc).  ``null_key``: rows
    for which the record id is NULL (all such rows form one key group)."""
    recid = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    if null_key is not None:
        recid = F.when(~null_key, recid)
    return li.select(
        recid.alias("recid"),
        F.when(F.col("l_linestatus") != "O", F.year("l_shipdate")).cast("bigint").alias("versionnumber"),
        F.col("l_shipdate").alias("SinkModifiedOn"),
        F.col("l_suppkey").alias("recversion"),
        F.when(F.col("l_returnflag") == "R", F.lit(True))
         .when(F.col("l_returnflag") == "A", F.lit(False)).alias("IsDelete"),
        *PAYLOAD)


def first_batch(changes: DataFrame) -> DataFrame:
    return changes.filter(F.col("SinkModifiedOn") < F.lit(CUTOFF).cast("timestamp_ntz"))


def second_batch(changes: DataFrame) -> DataFrame:
    """Later changes, and earlier ones sent again as they were (one supplier in ``RESENT``)."""
    return changes.filter((F.col("SinkModifiedOn") >= F.lit(CUTOFF).cast("timestamp_ntz"))
                          | (F.col("recversion") % RESENT == 0))


def folder_of(ts: Column) -> Column:
    """Landing folder name of a timestamp: its day, as ``yyyy-MM-ddT00.00.00Z``."""
    return F.date_format(F.date_trunc("day", ts), FOLDER_FORMAT)


def nation_enums(nation: DataFrame) -> DataFrame:
    """Enum metadata rows derived from ``nation`` (fixed eight-column layout):
    customer nation codes of four regions (codes of the fifth are unlisted),
    a second-language label for region 0, another entity's attribute, and an
    attribute the customer table does not have.  ``c_state`` and ``c_tier`` are
    further attributes of the customers."""
    def rows(attr: str, entity: str, lang: int, label: Column, cond: Column) -> DataFrame:
        return nation.filter(cond).select(
            F.lit(attr).alias("OptionSetName"), F.col("n_nationkey").cast("bigint").alias("Option"),
            F.lit(False).alias("IsUserLocalizedLabel"), F.lit(lang).cast("bigint").alias("LocalizedLabelLanguageCode"),
            label.alias("LocalizedLabel"), F.lit("nation").alias("GlobalOptionSetName"),
            F.lit(entity).alias("EntityName"), label.alias("OptionName"))
    r = F.col("n_regionkey")
    return (rows("c_nationkey", "customer", 1033, F.col("n_name"), r != 4)
            .unionByName(rows("c_nationkey", "customer", 1031, F.lower("n_name"), r == 0))
            .unionByName(rows("s_nationkey", "supplier", 1033, F.col("n_name"), F.lit(True)))
            .unionByName(rows("c_missing", "customer", 1033, F.col("n_name"), r == 1))
            .unionByName(rows("c_state", "customer", 1033, F.upper("n_name"), F.col("n_nationkey") < 10))
            .unionByName(rows("c_tier", "customer", 1033, F.concat(F.lit("it's "), "n_name"), r == 3)))


# Attribute names and type names of the derived model
# (they cover suffixing, renames, sink columns and an unknown type).
MODEL_NAMES = ("Id", "id", "fno_id", "Name", "NAME", "name1", "SinkModifiedOn",
               "SinkCreatedOn", "recid", "Amount")
MODEL_TYPES = ("datetime", "datetimeoffset", "date", "boolean", "int16", "int32", "int64",
               "float", "double", "decimal", "string", "guid", "Int64", "DateTime", "money")


def model_attributes_from_lineitem(li: DataFrame) -> DataFrame:
    """One entity per order, one attribute per line: ``entity, ordinal,
    name, data_type`` with names and types picked by part / supplier key."""
    from pyspark.sql import Window
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey",
                                                  "l_quantity", "l_extendedprice", "l_shipdate")
    names = F.array(*[F.lit(n) for n in MODEL_NAMES])
    types = F.array(*[F.lit(t) for t in MODEL_TYPES])
    return li.select(
        F.concat(F.lit("order_"), F.col("l_orderkey").cast("string")).alias("entity"),
        (F.row_number().over(w) - 1).cast("int").alias("ordinal"),
        F.element_at(names, (F.pmod("l_partkey", F.lit(len(MODEL_NAMES))) + 1).cast("int")).alias("name"),
        F.element_at(types, (F.pmod("l_suppkey", F.lit(len(MODEL_TYPES))) + 1).cast("int")).alias("data_type"))


def invoice_tables(li: DataFrame, orders: DataFrame, dealt: bool = False) -> tuple[DataFrame, DataFrame]:
    """Invoice header (one per order and ship date) and invoice lines.

    With ``dealt`` both lie by (invoiceid, invoicedate): their rows are shuffled while they are narrow numbers, so a
    join on these keys moves neither again.  It costs a shuffle where there is no such join.
    """
    d = F.col("l_shipdate").cast("date")

    def by_invoice(df: DataFrame, date: Column) -> DataFrame:
        return df.repartition(F.col("l_orderkey").cast("string"), date) if dealt else df

    lines = by_invoice(li, d).select(
        F.col("l_orderkey").cast("string").alias("invoiceid"), d.alias("invoicedate"),
        F.lit(COMPANY).alias("dataareaid"), F.lit("USD").alias("currencycode"),
        F.col("l_orderkey").cast("string").alias("salesid"), F.col("l_linenumber").alias("linenum"),
        F.col("l_partkey").cast("string").alias("itemid"), F.col("l_quantity").alias("qty"),
        F.col("l_extendedprice").cast("decimal(38,6)").alias("lineamount"))
    tax = (F.col("l_extendedprice").cast("decimal(15,2)") * F.col("l_tax").cast("decimal(15,2)")).cast("decimal(38,6)")
    # By the order alone, so that the join with the orders finds the sums where they are.
    per_order = li.repartition("l_orderkey") if dealt else li
    agg = (per_order.groupBy("l_orderkey", d.alias("invoicedate"))
           .agg(F.sum(F.col("l_extendedprice").cast("decimal(38,6)")).alias("invoiceamount"),
                F.sum(tax).alias("sumtax")))
    summed = agg.join(orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    header = by_invoice(summed, F.col("invoicedate")).select(
        F.col("l_orderkey").cast("string").alias("invoiceid"), "invoicedate",
        F.col("o_custkey").cast("string").alias("orderaccount"),
        F.col("o_custkey").cast("string").alias("invoiceaccount"),
        F.lit("USD").alias("currencycode"),
        F.concat(F.lit("LV"), F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.date_format("invoicedate", "yyyyMMdd")).alias("ledgervoucher"),
        "invoiceamount", F.col("invoiceamount").alias("invoiceamountmst"),
        "sumtax", F.col("sumtax").alias("sumtaxmst"), F.lit(COMPANY).alias("dataareaid"))
    return header, lines


def third_batch(changes: DataFrame) -> DataFrame:
    """Of the second batch, every fourth supplier's records sent again with more, and the next one's as deletes."""
    again = second_batch(changes).filter(F.col("recversion") % 4 < 2)
    return again.withColumns({"l_quantity": F.col("l_quantity") + 1, "IsDelete": F.col("recversion") % 4 == 1})
