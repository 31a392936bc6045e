"""Silver job (operators M7, M8, B10): business views from bronze tables by name.

Reads the bronze tables from the store (bucketed tables keep their layout:
a join on a table's record key, such as party -> ``dirpartytable.recid``,
then exchanges only the other side) and materialises each view unless it
already exists (or on ``refresh``).  Both views fail on a row whose customer
name is empty after defaulting; the stored view is then left as it was.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidemark.operators.silver import build_view, customer_rows, silver_customer, silver_sales_invoice
from tidemark.sinks.store import Snapshot, TableStore

# Bronze tables the views read.
CUSTOMER_TABLES = ("custtable", "custgroup", "dirpartytable")
INVOICE_TABLES = ("custinvoicejour", "custinvoicetrans")


def build_silver_views(spark: SparkSession, bronze: TableStore, silver: TableStore,
                       refresh: bool = False) -> dict[str, Snapshot | None]:
    """Build ``silver_customer`` and ``silver_sales_invoice`` from ``bronze``
    into ``silver``; a view whose bronze tables are missing is skipped (None)."""
    have = bronze.current_all()
    out: dict[str, Snapshot | None] = {}
    if all(t in have for t in CUSTOMER_TABLES):
        cust, group, party = (bronze.read(t, have[t]) for t in CUSTOMER_TABLES)
        out["silver_customer"] = build_view(silver, "silver_customer", silver_customer(cust, group, party), refresh)
    else:
        out["silver_customer"] = None
    if all(t in have for t in INVOICE_TABLES + CUSTOMER_TABLES):
        header, lines = (bronze.read(t, have[t]) for t in INVOICE_TABLES)
        customers = customer_rows(*(bronze.read(t, have[t]) for t in CUSTOMER_TABLES))
        out["silver_sales_invoice"] = build_view(silver, "silver_sales_invoice",
                                                 silver_sales_invoice(header, lines, customers), refresh)
    else:
        out["silver_sales_invoice"] = None
    return out
