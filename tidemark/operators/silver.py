"""Silver views (operators E1-E4, J9, C7, C8, D10, B10, M7-M9).

Business views over bronze tables: inner equi-joins, NULL defaulting and a
row check that fails the build when a row violates it (a NULL check result
is a violation).  Joins are declared; Catalyst/AQE choose broadcast or
sort-merge from the actual sizes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.predicates import check_passes



def name_check() -> tuple[str, Column]:
    """The view's row check: the customer name is not empty."""
    return "name_check", F.col("customername") != F.lit("")


def enforce(df: DataFrame, name: str, condition: Column) -> DataFrame:
    """Fail the query on the first row where ``condition`` is not true.

    The check is a filter, so column pruning cannot remove it, and its message
    shows the whole row: as it refers to columns of all joined sides, it can't
    be moved below the joins onto rows that never reach the view.
    """
    message = F.concat(F.lit(f"CHECK {name} violated: "), F.to_json(F.struct(*df.columns)))
    return df.filter(F.when(check_passes(condition), F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))


def violations(df: DataFrame, condition: Column) -> DataFrame:
    """Rows that would fail the check."""
    return df.filter(~check_passes(condition))


def silver_customer(cust: DataFrame, custgroup: DataFrame, dirparty: DataFrame,
                    check: bool = True) -> DataFrame:
    """M7: customer x group (two keys: group, company) x party (one key)."""
    out = customer_rows(cust, custgroup, dirparty).select(*CUSTOMER_COLUMNS)
    return enforce(out, *name_check()) if check else out


def customer_rows(cust: DataFrame, custgroup: DataFrame, dirparty: DataFrame) -> DataFrame:
    """The customer view's rows, unchecked, with their company ``dataareaid``."""
    c, g, p = cust.alias("cust"), custgroup.alias("custgroup"), dirparty.alias("dirparty")
    return (c.join(g, (F.col("custgroup.custgroup") == F.col("cust.custgroup"))
                  & (F.col("custgroup.dataareaid") == F.col("cust.dataareaid")), "inner")
           .join(p, F.col("dirparty.recid") == F.col("cust.party"), "inner")
           .select(F.col("cust.accountnum"), F.col("cust.custgroup"), F.col("cust.dlvterm"),
                   F.col("cust.party"), F.col("custgroup.name").alias("customergroup"),
                   F.coalesce(F.col("dirparty.name"), F.lit("")).alias("customername"),
                   F.col("cust.dataareaid").alias("dataareaid")))


def silver_sales_invoice(header: DataFrame, lines: DataFrame, customers: DataFrame | None = None,
                         check: bool = True) -> DataFrame:
    """M8 (as intended): invoice header x invoice lines on
    (invoiceid, invoicedate, dataareaid); header columns then line columns.

    With ``customers`` (the unchecked customer view with its company, see
    ``customer_rows``) each invoice also carries the columns of its invoice
    account, and the view's row check holds.
    """
    h, l = header.alias("cij"), lines.alias("cit")
    keys = ("invoiceid", "invoicedate", "dataareaid")
    cond = None
    for k in keys:
        c = F.col(f"cij.{k}") == F.col(f"cit.{k}")
        cond = c if cond is None else cond & c
    line_cols = [F.col(f"cit.{c}").alias(f"line_{c}") for c in lines.columns if c not in keys and c in header.columns]
    line_cols += [F.col(f"cit.{c}") for c in lines.columns if c not in keys and c not in header.columns]
    joined = h.join(l, cond, "inner")
    if customers is None:
        return joined.select(*[F.col(f"cij.{c}") for c in header.columns], *line_cols)
    cust = customers.alias("customer")
    joined = joined.join(cust, (F.col("customer.accountnum") == F.col("cij.invoiceaccount"))
                         & (F.col("customer.dataareaid") == F.col("cij.dataareaid")), "inner")
    out = joined.select(*[F.col(f"customer.{c}") for c in CUSTOMER_COLUMNS],
                        *[F.col(f"cij.{c}") for c in header.columns], *line_cols)
    return enforce(out, *name_check()) if check else out


# Columns of the customer view, and of the profiles below.
CUSTOMER_COLUMNS = ("accountnum", "custgroup", "dlvterm", "party", "customergroup", "customername")
HEADER_PROFILE = ("invoiceid", "invoicedate", "orderaccount", "invoiceaccount", "currencycode",
                  "ledgervoucher", "invoiceamount", "invoiceamountmst", "sumtax", "sumtaxmst",
                  "dataareaid")
LINE_LEAD = ("invoiceid", "invoicedate", "currencycode", "salesid")


def invoice_header_profile(header: DataFrame) -> DataFrame:
    """M9: the header columns profiled by the reference view."""
    return header.select(*HEADER_PROFILE)


def invoice_line_profile(lines: DataFrame, distinct_names: bool = True) -> DataFrame:
    """Lead columns, then every column, then ``dataareaid``.

    Plain star expansion repeats the lead columns (a frame that cannot be
    written); with ``distinct_names`` the star part skips them.
    """
    lead = list(LINE_LEAD)
    if not distinct_names:
        return lines.select(*lead, "*", "dataareaid")
    rest = [c for c in lines.columns if c not in lead and c != "dataareaid"]
    return lines.select(*lead, *rest, "dataareaid")


def build_view(store, name: str, df: DataFrame, refresh: bool = False):
    """Materialise ``df`` as table ``name`` unless it exists (or on refresh)."""
    if store.exists(name) and not refresh:
        return store.current(name)
    return store.replace(name, df, mode="view")
