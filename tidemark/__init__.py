"""tidemark: change-row ingestion into current-state tables, on Spark.

Landing CSV exports (timestamp-named folders) are turned into one
current-state table per entity, merged incrementally behind a
high-water mark, and joined into business views.  Every step is a
DataFrame / SQL plan; Catalyst and AQE choose the physical strategy.

Main entry points::

    cfg = LandingConfig(landing_root=..., store_root=...)
    load_enums(spark, cfg)                                   # enum metadata
    run_log = ingest_all(spark, cfg, read_config(spark, path), processing_group="pg_daily")
    build_silver_views(spark, TableStore(spark, cfg.store_root), TableStore(spark, silver_root))
"""

from tidemark.config import LandingConfig
from tidemark.operators.latest import latest_change, latest_version
from tidemark.operators.merge import merge
from tidemark.plans.ingest import ingest_all, ingest_table, load_enums, run_outcome
from tidemark.plans.silver import build_silver_views
from tidemark.sinks.store import TableStore
from tidemark.sources.tables import read_config, select_tables
from tidemark.streaming.landing_stream import stream_table

__all__ = ["LandingConfig", "latest_change", "latest_version", "merge", "ingest_all", "ingest_table",
           "load_enums", "run_outcome", "build_silver_views", "TableStore", "read_config",
           "select_tables", "stream_table"]
