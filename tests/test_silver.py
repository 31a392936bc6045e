import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators.silver import (build_view, invoice_line_profile, silver_customer,
                                       silver_sales_invoice, violations)
from tidemark.sinks.store import TableStore

CUST = "accountnum STRING, custgroup STRING, dlvterm STRING, party BIGINT, dataareaid STRING"
GROUP = "custgroup STRING, dataareaid STRING, name STRING"
PARTY = "recid BIGINT, name STRING"


def frames(spark, party_rows):
    cust = spark.createDataFrame([("A", "g1", "d", 1, "c1"), ("B", "g1", "d", 2, "c2"), ("C", "g2", "d", 3, "c1")], CUST)
    group = spark.createDataFrame([("g1", "c1", "Group one"), ("g1", "c2", "Group one c2"), ("g2", "c9", "x")], GROUP)
    return cust, group, spark.createDataFrame(party_rows, PARTY)


def test_two_key_and_one_key_inner_joins(spark):
    out = silver_customer(*frames(spark, [(1, "Ann"), (2, "Bob"), (3, "Cy")])).collect()
    assert sorted((r["accountnum"], r["customergroup"], r["customername"]) for r in out) == [
        ("A", "Group one", "Ann"), ("B", "Group one c2", "Bob")]     # C: company c1 has no g2 group


def test_check_fails_on_null_name_after_default(spark):
    parts = frames(spark, [(1, None), (2, "Bob")])
    with pytest.raises(Exception, match="name_check"):
        silver_customer(*parts).collect()
    bad = violations(silver_customer(*parts, check=False), F.col("customername") != "").collect()
    assert [(r["accountnum"], r["customername"]) for r in bad] == [("A", "")]


def test_check_looks_at_view_rows_only(spark):
    """A party that no customer refers to may be blank, however the joins are planned."""
    parts = frames(spark, [(1, "Ann"), (2, "Bob"), (77, None), (78, "")])
    out = silver_customer(*parts)
    assert out.count() == 2 and {r["customername"] for r in out.filter("customername like '%n%'").collect()} == {"Ann"}
    assert out.select("accountnum").distinct().count() == 2
    with pytest.raises(Exception, match="name_check"):
        silver_customer(*frames(spark, [(1, None), (2, "Bob")])).select("accountnum").count()


def test_build_view_skips_existing(spark, tmp_dir):
    store = TableStore(spark, tmp_dir)
    df = silver_customer(*frames(spark, [(1, "Ann"), (2, "Bob")]))
    first = build_view(store, "silver_customer", df)
    again = build_view(store, "silver_customer", df.limit(0))
    assert again.path == first.path and store.read("silver_customer").count() == 2
    refreshed = build_view(store, "silver_customer", df.limit(1), refresh=True)
    assert refreshed.path != first.path and store.read("silver_customer").count() == 1


def test_invoice_join_and_line_profile(spark):
    h = spark.createDataFrame([("I1", "2024-01-01", "c1", "USD", 10)],
                              "invoiceid STRING, invoicedate STRING, dataareaid STRING, currencycode STRING, amt INT")
    l = spark.createDataFrame([("I1", "2024-01-01", "c1", "USD", "S1", 1), ("I1", "2024-01-02", "c1", "USD", "S1", 2)],
                              "invoiceid STRING, invoicedate STRING, dataareaid STRING, currencycode STRING, salesid STRING, n INT")
    out = silver_sales_invoice(h, l).collect()
    assert len(out) == 1 and out[0]["line_currencycode"] == "USD" and out[0]["n"] == 1
    assert invoice_line_profile(l).columns == ["invoiceid", "invoicedate", "currencycode", "salesid", "n", "dataareaid"]
    assert invoice_line_profile(l, distinct_names=False).columns.count("invoiceid") == 2


def test_silver_job_from_bronze_store(spark, tmp_dir):
    from tidemark.plans.silver import build_silver_views
    bronze, silver = TableStore(spark, f"{tmp_dir}/bronze"), TableStore(spark, f"{tmp_dir}/silver")
    cust, group, party = frames(spark, [(1, "Ann"), (2, "Bob"), (3, "Cy")])
    for name, df in (("custtable", cust), ("custgroup", group), ("dirpartytable", party)):
        bronze.replace(name, df)
    built = build_silver_views(spark, bronze, silver)
    assert built["silver_sales_invoice"] is None                      # its bronze tables are absent
    assert sorted(r["accountnum"] for r in silver.read("silver_customer").collect()) == ["A", "B"]
    h = "invoiceid STRING, invoicedate STRING, dataareaid STRING, currencycode STRING, invoiceaccount STRING"
    bronze.replace("custinvoicejour", spark.createDataFrame([("I1", "d", "c1", "USD", "A"), ("I2", "d", "c9", "USD", "A")], h))
    bronze.replace("custinvoicetrans", spark.createDataFrame([("I1", "d", "c1", 5), ("I2", "d", "c9", 6)],
                                                            "invoiceid STRING, invoicedate STRING, dataareaid STRING, n INT"))
    bronze.replace("dirpartytable", spark.createDataFrame([(1, "Ann"), (2, "Bob")], PARTY))
    build_silver_views(spark, bronze, silver)
    invoice = silver.read("silver_sales_invoice").collect()
    assert [(r["invoiceid"], r["customername"], r["n"]) for r in invoice] == [("I1", "Ann", 5)]
    bronze.replace("dirpartytable", spark.createDataFrame([(1, None), (2, "Bob")], PARTY))
    with pytest.raises(Exception, match="name_check"):
        build_silver_views(spark, bronze, silver, refresh=True)
    assert sorted(r["accountnum"] for r in silver.read("silver_customer").collect()) == ["A", "B"]  # unchanged


def test_dealt_invoices_are_not_moved_again_by_their_join(spark):
    from tidemark.workloads.derive import invoice_tables
    li = spark.createDataFrame(
        [(o, n, 5 * n, 1, float(n), 10.25 * n, 0.01 * n, dt.datetime(2024, 1, 1 + n % 2) if n != 3 else None)
         for o in [*range(40), None] for n in (1, 2, 3, 4, 4)],
        "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, "
        "l_tax double, l_shipdate timestamp_ntz")
    orders = spark.createDataFrame([(o, o % 7 if o % 5 else None) for o in [*range(35), 3, 4]], "o_orderkey long, o_custkey long")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans, rows = [], []
        for dealt in (True, False):
            out = silver_sales_invoice(*invoice_tables(li, orders, dealt))
            plan = out._jdf.queryExecution().executedPlan().toString()
            plans.append([x for x in plan.splitlines() if "Exchange" in x])
            rows.append(sorted(map(str, out.collect())))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # The lines twice, the orders and the sums once each: the last two of them narrow, before names and texts are made.
    assert len(plans[0]) == 4 and len(plans[1]) == 5
    assert not any("hashpartitioning(invoiceid" in x for x in plans[0])
    assert sum("hashpartitioning(invoiceid" in x for x in plans[1]) == 2
    assert rows[0] == rows[1] and len(rows[0]) == 35 * 4 + 2 * 4
