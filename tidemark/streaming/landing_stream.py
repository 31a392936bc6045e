"""Incremental loads as a stream of closed landing folders.

A file stream would consume whatever it lists, also the folder that is still being written.  Here the
stream's offsets are folder names: the latest offset is the last folder before the one that
the changelog names, so an open folder is no part of any batch.  The stream carries names only; each
micro-batch loads its folders through exactly the batch path (CSV scan, key repair, enum decode,
latest version, staged merge, snapshot + log row).

A batch that Spark replays (the job died between its commit and the stream's checkpoint) is recognised by its
id in the load log, and nothing is loaded twice; a folder at or before the table's own mark never is.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from tidemark.config import CHANGELOG_FILE, LandingConfig
from tidemark.plans.ingest import enum_table, ingest_table
from tidemark.session import ship_code
from tidemark.sinks.store import TableStore
from tidemark.sources.landing import loadable_folders, name_is_open


class FolderRange(InputPartition):
    """Folder names of one micro-batch."""

    def __init__(self, names: list[str]):
        self.names = names


class ClosedFolders(DataSource):
    """Streaming source ``tidemark_folders``: a row for each closed landing folder, in the order of names.

    Option ``root``: the landing root, a path or a URI that Arrow's file systems know.
    """

    @classmethod
    def name(cls) -> str:
        return "tidemark_folders"

    def schema(self) -> str:
        return "folder STRING"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return ClosedFolderReader(self.options["root"])


class ClosedFolderReader(DataSourceStreamReader):
    """Offsets are ``{"folder": name}``: the last folder of all batches up to there."""

    def __init__(self, root: str):
        self.root = root

    def _place(self):
        from pyarrow import fs
        root = self.root
        if root.startswith("file:"):
            root = "/" + root[5:].lstrip("/")
        return fs.FileSystem.from_uri(root) if "://" in root else (fs.LocalFileSystem(), root)

    def _closed(self) -> list[str]:
        """Names of the folders that are no longer written, by the batch job's rule."""
        from pyarrow import fs
        files, root = self._place()
        found = files.get_file_info(fs.FileSelector(root))
        names = sorted(f.base_name for f in found if f.type == fs.FileType.Directory)
        return [n for n in names if name_is_open(n, None, self._latest(files, root))]

    @staticmethod
    def _latest(files, root: str) -> str | None:
        """First line of the changelog, a file or a folder of text files; None where it is empty."""
        from pyarrow import fs
        path = f"{root.rstrip('/')}/{CHANGELOG_FILE}"
        info = files.get_file_info(path)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(path)
        parts = [path] if info.type == fs.FileType.File else sorted(
            f.path for f in files.get_file_info(fs.FileSelector(path)) if not f.base_name.startswith(("_", ".")))
        for part in parts:
            with files.open_input_stream(part) as stream:
                if text := stream.read().decode():
                    return text.splitlines()[0]
        return None

    def initialOffset(self) -> dict:
        return {"folder": ""}

    def latestOffset(self, *_) -> dict:
        return {"folder": max(self._closed(), default="")}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [FolderRange([n for n in self._closed() if start["folder"] < n <= end["folder"]])]

    def read(self, partition: FolderRange) -> Iterator[tuple[str]]:
        yield from ((n,) for n in partition.names)


def folder_stream(spark: SparkSession, cfg: LandingConfig) -> DataFrame:
    """Streaming DataFrame of the closed folders' names."""
    ship_code(spark)
    spark.dataSource.register(ClosedFolders)
    return spark.readStream.format(ClosedFolders.name()).option("root", cfg.landing_root).load()


def load_batch(spark: SparkSession, cfg: LandingConfig, store: TableStore, table: str, names: set[str], batch: str) -> dict | None:
    """Load a batch's folders into ``table``; None where the batch was loaded before or holds nothing for it."""
    if store.has_batch(table, batch):
        return None
    current = store.current(table)
    mark = current.lastload if current is not None else None
    folders = [f for f in loadable_folders(spark, cfg.landing_root, {table: mark}, None)[table] if f in names]
    if not folders:
        return None
    return ingest_table(spark, cfg, table, store=store, folders=folders, current=current, batch=batch)


def stream_table(spark: SparkSession, cfg: LandingConfig, table: str,
                 checkpoint: str | None = None, store: TableStore | None = None) -> StreamingQuery:
    """Start an ``availableNow`` stream that loads every closed folder of ``table`` not yet
    loaded, and stops.  ``checkpoint`` defaults to a folder in the store."""
    store = store or TableStore(spark, cfg.store_root)
    checkpoint = checkpoint or f"{store.root}/_streams/{table}"
    if cfg.decode_enums and enum_table(store) is None:
        raise ValueError("the enum metadata has not been loaded")

    def load(batch: DataFrame, epoch_id: int) -> None:
        stream = spark.read.json(f"{checkpoint}/metadata").head()["id"]  # of this checkpoint, for good
        names = {r["folder"] for r in batch.collect()}                   # folder names only
        load_batch(spark, cfg, store, table, names, f"{stream}/{epoch_id}")

    return (folder_stream(spark, cfg).writeStream.foreachBatch(load)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


__all__ = ["ClosedFolders", "folder_stream", "load_batch", "stream_table"]
