"""Configuration of one landing area and its bronze store.

The fixed values below must equal the exporter's conventions for right
results; they are stated once, here.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values (exporter conventions) --------------------------------
# Column renames applied to model attribute names (exact case).
RENAME_COLUMNS = {"Id": "sl_id", "fno_id": "id"}
# Metadata columns removed before a row is stored.
EXCLUDED_META_COLUMNS = ("sl_id", "versionnumber", "tableid",
                         "modifiedtransactionid", "createdtransactionid")
# Columns never compared when deciding whether a stored row changed.
IGNORED_COMPARE_COLUMNS = ("_sysProcessedDateTime", "SinkCreatedOn",
                           "_sysCreatedDateTime", "SinkModifiedOn")
# Entries of the landing root that are not data folders.
SYSTEM_FOLDERS = ("Changelog", "EntitySyncFailure",
                  "Microsoft.Athena.TrickleFeedService", "model.json")
# Sink timestamps are written in this text form.
SINK_TIMESTAMP_FORMAT = "M/d/yyyy h:mm:ss a"
SINK_TIMESTAMP_COLUMNS = ("SinkCreatedOn", "SinkModifiedOn")
# Record key and version order used to pick the latest change of a record.
RECORD_KEY = "RECID"
VERSION_ORDER = ("VersionNumber", "SinkModifiedOn", "RecVersion")
DELETE_FLAG = "IsDelete"
# Load-time stamps (created on insert, processed on every write).
CREATED_STAMP = "_sysCreatedDateTime"
PROCESSED_STAMP = "_sysProcessedDateTime"
# Enum metadata file and its fixed layout.
ENUM_TABLE = "_enum_translations"
ENUM_FILE = "OptionsetMetadata/GlobalOptionsetMetadata.csv"
ENUM_SCHEMA_DDL = ("OptionSetName STRING, Option BIGINT, IsUserLocalizedLabel BOOLEAN, "
                   "LocalizedLabelLanguageCode BIGINT, LocalizedLabel STRING, "
                   "GlobalOptionSetName STRING, EntityName STRING, OptionName STRING")
CHANGELOG_FILE = "Changelog/changelog.info"
MODEL_FILE = "model.json"
# Column of a record's text where it doesn't fit the model; no model has it.
BAD_RECORD = "_bad_record"
# -------------------------------------------------------------------------


@dataclass(frozen=True)
class LandingConfig:
    """Where a landing area lives and where its bronze tables go.

    ``landing_root``: folder holding ``model.json``, ``Changelog/`` and the
    timestamp-named export folders.  ``store_root``: folder of the bronze
    store (snapshots + load log).  Both should be shared (distributed FS)
    paths on a cluster.
    """

    landing_root: str
    store_root: str
    key: tuple[str, ...] = (RECORD_KEY,)
    version_order: tuple[str, ...] = VERSION_ORDER
    delete_flag: str = DELETE_FLAG
    rename: dict = field(default_factory=lambda: dict(RENAME_COLUMNS))
    excluded_meta: tuple[str, ...] = EXCLUDED_META_COLUMNS
    ignored_compare: tuple[str, ...] = IGNORED_COMPARE_COLUMNS
    # Decode enum columns; a load then needs the enum metadata table.
    decode_enums: bool = True
    # Codes of one enum attribute up to which its labels are part of the
    # projection; an attribute with more is decoded by a join.
    inline_enum_codes: int = 1_000
    # CSV files over this size are cut between records and read by several tasks; 0: each file in one.
    csv_range_bytes: int = 256 * 1024 * 1024
    # Seconds after which ``ingest_all`` stops a table's load; 0: no limit.
    table_seconds: float = 3600
    # Write load-time stamps into stored rows.
    stamp_rows: bool = True
    # Store tables bucketed by the record key columns (merges then exchange
    # only the change set).  ``buckets`` = 0 sizes the bucket count at every load:
    # a power of two giving at most ``bucket_bytes`` of stored data and ``bucket_memory``
    # bytes of rows as tasks hold them (a bucket is joined and sorted by one task, and
    # stored files may be many times smaller than their rows) per bucket; a
    # merge changes it when it is off by a factor of two.  ``max_buckets`` stays
    # below Spark's own limit (spark.sql.sources.bucketing.maxBuckets).
    bucketed: bool = True
    buckets: int = 0
    bucket_bytes: int = 128 * 1024 * 1024
    bucket_memory: int = 64 * 1024 * 1024
    max_buckets: int = 65536
    # A merge whose changes fall into this share of the buckets or less reads and writes
    # only these; after ``max_layers`` such loads, or with more buckets touched, all are written again.
    touched_share: float = 0.25
    max_layers: int = 16

    @property
    def model_path(self) -> str:
        return f"{self.landing_root.rstrip('/')}/{MODEL_FILE}"

    @property
    def changelog_path(self) -> str:
        return f"{self.landing_root.rstrip('/')}/{CHANGELOG_FILE}"
