"""Sources: landing-folder planning, CSV scans, the model document, config tables."""

from tidemark.sources.csvscan import ENTITY_CSV_OPTIONS, read_entity_csv, read_enum_csv
from tidemark.sources.landing import (changelog_folders, changelog_head, changelog_latest,
                                      closed_folders, landing_files, plan_loads, table_folders)
from tidemark.sources.model import (entity_schema, model_attributes, read_model,
                                    schema_catalog)
from tidemark.sources.tables import read_config, select_tables

__all__ = ["ENTITY_CSV_OPTIONS", "read_entity_csv", "read_enum_csv", "changelog_folders",
           "changelog_head", "changelog_latest", "closed_folders", "landing_files",
           "plan_loads", "table_folders", "entity_schema", "model_attributes", "read_model",
           "schema_catalog", "read_config", "select_tables"]
