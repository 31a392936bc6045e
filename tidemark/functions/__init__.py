"""Column-level functions: key repair, timestamp parsing, enum decoding, predicates."""

from tidemark.functions.columns import find_column, has_column
from tidemark.functions.keys import (guid_from_ids, record_id_from_guid, repair_keys,
                                     table_id_from_guid)
from tidemark.functions.predicates import is_delete, rows_differ, compare_columns
from tidemark.functions.timestamps import parse_iso_timestamp, parse_sink_timestamp

__all__ = ["find_column", "has_column", "guid_from_ids", "record_id_from_guid",
           "repair_keys", "table_id_from_guid", "is_delete", "rows_differ",
           "compare_columns", "parse_iso_timestamp", "parse_sink_timestamp"]
