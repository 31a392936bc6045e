"""Job plans: table loads, multi-table runs with a run log, enum metadata load."""

from tidemark.plans.ingest import (RUN_LOG_DDL, ingest_all, ingest_table, load_enums,
                                   plan_tables, read_changes, run_outcome)

from tidemark.plans.silver import build_silver_views

__all__ = ["build_silver_views", "RUN_LOG_DDL", "ingest_all", "ingest_table", "load_enums", "plan_tables",
           "read_changes", "run_outcome"]
