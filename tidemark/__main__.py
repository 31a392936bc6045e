"""Command-line run of a load (the master job's parameters as arguments).

    python -m tidemark --landing <root> --store <root> --config <path> \\
        [--config-format parquet|table|csv|json] [--group pg_daily] [--tables a,b] \\
        [--reload] [--parallelism 4] [--no-enums]

Loads the enum metadata (unless ``--no-enums``), loads every selected table,
prints the run log and PASS/FAIL, and exits with status 1 on FAIL.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from tidemark.config import LandingConfig
from tidemark.plans.ingest import ingest_all, load_enums, run_outcome
from tidemark.session import ensure_checkpoint_dir
from tidemark.sources.tables import read_config


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    p = argparse.ArgumentParser(prog="tidemark")
    p.add_argument("--landing", required=True)
    p.add_argument("--store", required=True)
    p.add_argument("--config", required=True, help="config table: path, or a catalog name with --config-format table")
    p.add_argument("--config-format", default="parquet")
    p.add_argument("--group", default=None)
    p.add_argument("--tables", default=None, help="comma-separated table names")
    p.add_argument("--reload", action="store_true")
    p.add_argument("--parallelism", type=int, default=4)
    p.add_argument("--no-enums", action="store_true")
    a = p.parse_args(argv)
    spark = spark or SparkSession.builder.appName("tidemark").getOrCreate()
    ensure_checkpoint_dir(spark)
    cfg = LandingConfig(landing_root=a.landing, store_root=a.store, decode_enums=not a.no_enums)
    if not a.no_enums:
        load_enums(spark, cfg)
    config = read_config(spark, a.config, a.config_format)
    log = ingest_all(spark, cfg, config, a.group, a.tables, a.reload, a.parallelism)
    for r in log.collect():
        print(f"{r['table']}: {r['status']} {r['strategy'] or ''} rows={r['rows_after']} "
              f"folders={r['folder_from']}..{r['folder_to']} {r['error'] or r['warning'] or ''}".rstrip())
    outcome = run_outcome(log)
    print(f"{outcome['result']}: {outcome['errors']} error(s)")
    return 1 if outcome["result"] == "FAIL" else 0


if __name__ == "__main__":
    sys.exit(main())
